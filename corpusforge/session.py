"""Session construction and the shared place where lineage is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_TEST_DIRS: list[str] = []


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusforge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors share.

    Only where the setting is absent and the master is local (tests on one machine) a temporary
    folder is made, which is deleted when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    if not _TEST_DIRS:
        _TEST_DIRS.append(tempfile.mkdtemp(prefix="corpusforge-"))
        atexit.register(shutil.rmtree, _TEST_DIRS[0], True)
    return _TEST_DIRS[0]


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/corpusforge-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete what this application wrote with materialize(); results that were not written elsewhere can't be read after it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write df once to the shared folder and read it back.

    Cuts the lineage (a lost executor costs a re-read, not a re-run), keeps Python stages from
    running twice when the result is used twice, and gives the optimizer true sizes.
    """
    spark = df.sparkSession
    path = f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what materialize() wrote for these tables; for rounds, once the next table is written and nothing lazy reads the old one."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def is_small(df: DataFrame, max_rows: int) -> bool:
    """True if df has at most max_rows rows; reads no more than needed to know."""
    return df.limit(max_rows + 1).count() <= max_rows
