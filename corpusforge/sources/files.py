"""JSON, CSV and configuration readers with a declared schema."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    system, hadoop = _at(spark, path)
    return system.exists(hadoop)


def count_folders(spark: SparkSession, path: str) -> int:
    """How many folders a folder holds; 0 if it is absent."""
    system, hadoop = _at(spark, path)
    return sum(1 for x in system.listStatus(hadoop) if x.isDirectory()) if system.exists(hadoop) else 0


def records(spark: SparkSession, path: str, schema: str, array: str, strict: bool = True, optional: bool = False) -> DataFrame:
    """The objects of the array field `array` of whole-file JSON, with `pos`, their place.

    strict: a file that does not fit the schema fails the read; else its bad values are null.
    optional: an absent path gives no rows instead of an error.
    """
    item = T._parse_datatype_string(schema)
    whole = T.StructType([T.StructField(array, T.ArrayType(item))])
    if optional and not exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField("pos", T.IntegerType()), *item.fields]))
    reader = spark.read.schema(whole).option("multiLine", True).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return reader.json(path).select(F.posexplode(array).alias("pos", "r")).select("pos", "r.*")


def delimited(spark: SparkSession, path: str, schema: str, separator: str = ",") -> DataFrame:
    """CSV or TSV with a header; quoted fields may hold line ends."""
    return spark.read.schema(schema).option("header", True).option("sep", separator).option("multiLine", True).option("escape", '"').csv(path)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def region_records(spark: SparkSession, path: str, optional: bool = True) -> DataFrame:
    """(doc, item): the records of figure regions in whole JSON files, one file per document (its name up to the first dot), under `figures` or `regions`."""
    if optional and not exists(spark, path):
        return spark.createDataFrame([], "doc string, item string").select("doc", F.try_parse_json("item").alias("item"))
    whole = spark.read.option("wholetext", True).text(path).select(F.regexp_extract(F.input_file_name(), r"([^/.]+)[^/]*$", 1).alias("doc"), F.try_parse_json("value").alias("v"))
    listed = F.coalesce(F.try_variant_get("v", "$.figures", "array<variant>"), F.try_variant_get("v", "$.regions", "array<variant>"))
    return whole.select("doc", F.explode(listed).alias("item"))


def json_object(path: str, optional: bool = False) -> dict | None:
    """The object of one small JSON file; None for an absent optional one; an error for any other top level."""
    file = Path(path)
    if optional and not file.is_file():
        return None
    value = json.loads(file.read_text(encoding="utf-8"))
    if not isinstance(value, dict):
        raise ValueError(f"{path}: the top level is no object")
    return value


def save_object(path: str, value: dict) -> None:
    """A small JSON file as a whole, indented, non-ASCII kept."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


def judgements(path: str) -> dict:
    """A file of judgements by query; one of schema version 1 without any where it is absent or has no version."""
    return {"schema_version": 1, "judgments": {}} | (json_object(path, optional=True) or {})


def settings(path: str | None, defaults: dict) -> dict:
    """A small configuration file (JSON, or YAML where a parser is installed) over defaults, merged level by level; defaults alone if it is absent."""
    given = {}
    if path and Path(path).exists():
        text = Path(path).read_text(encoding="utf-8")
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as missing:
                raise RuntimeError("YAML settings need a YAML parser; JSON does not") from missing
            given = yaml.safe_load(text) or {}
        else:
            given = json.loads(text)

    def merge(a: dict, b: dict) -> dict:
        return a | {k: merge(a[k], v) if isinstance(v, dict) and isinstance(a.get(k), dict) else v for k, v in b.items()}

    return merge(defaults, given)


def write_artifact(df: DataFrame, path: str) -> None:
    """Nested rows as JSON lines, non-ASCII kept; a folder of part files, replaced as a whole."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
