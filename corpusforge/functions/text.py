"""Scalar functions on strings, as column expressions that stay in the JVM.

All give null for null unless stated. White space means Unicode white space and the information
separators, as Python's str.split and str.strip see it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)[\s\x1c-\x1f]+"

# Venue names and their identifiers; organisers whose second path part names the venue.
VENUE_ALIASES = {"ICLR": "ICLR.cc", "NEURIPS": "NeurIPS.cc", "NIPS": "NeurIPS.cc", "ICML": "ICML.cc"}
SUBVENUES = ("acl", "emnlp", "naacl", "eacl", "arr")
YEAR = r"\b(?:19|20)\d{2}\b"


def tokens(c: Column) -> Column:
    """The pieces between white space."""
    return F.filter(F.split(c, SPACE), lambda t: t != "")


def token_count(c: Column) -> Column:
    return F.size(tokens(c))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def squeeze(c: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def nonempty(*columns: Column) -> Column:
    """The first that is neither null nor blank, stripped."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in columns])


def title_key(c: Column) -> Column:
    """Title for comparison: stripped, lower case, single blanks; null for blank."""
    return F.nullif(F.lower(squeeze(c)), F.lit(""))


def slug(c: Column, limit: int | None = 80, default: str = "item") -> Column:
    out = F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    return F.coalesce(F.nullif(F.substring(out, 1, limit) if limit else out, F.lit("")), F.lit(default))


def dataset_slug(c: Column) -> Column:
    """Name of a dataset for paths: letters, digits, underscores and hyphens kept, anything else an underscore, none at the ends."""
    out = F.regexp_replace(F.regexp_replace(strip(c), r"[^\p{L}\p{N}_-]", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(out, F.lit("")), F.lit("generated_queries"))


def safe_get(value: Column, path: str, kind: str = "string", default: object = None) -> Column:
    """What stands at a path ('$.a.b[0]') of a variant, or the default."""
    found = F.try_variant_get(value, path, kind)
    return found if default is None else F.coalesce(found, F.lit(default))


def short_hash(c: Column, length: int = 12) -> Column:
    return F.substring(F.sha1(c), 1, length)


def field_id(c: Column) -> Column:
    """Sum of place times code point, modulo 1000000007, as text; '0' for the empty string."""
    n = F.length(c)
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    step = lambda acc, i: F.pmod(acc + i.cast("bigint") * F.ascii(F.substring(c, i, 1)).cast("bigint"), F.lit(1_000_000_007))
    return F.when(c.isNotNull(), F.aggregate(places, F.lit(0).cast("bigint"), step).cast("string"))


def year_in(c: Column) -> Column:
    """The first four-digit year of 1900 to 2099 standing alone."""
    return F.regexp_extract(c, r"\b((?:19|20)\d{2})\b", 1).try_cast("int")


def venue_id(c: Column) -> Column:
    """Stripped, blanks as underscores, known aliases replaced."""
    plain = F.replace(strip(c), F.lit(" "), F.lit("_"))
    out = plain
    for alias, name in VENUE_ALIASES.items():
        out = F.when(F.upper(plain) == alias, name).otherwise(out)
    return out


def is_fallback_venue(c: Column) -> Column:
    return F.coalesce(venue_id(c).isin(*sorted(set(VENUE_ALIASES.values()))), F.lit(False))


def venue_of_path(c: Column) -> Column:
    """The part of a venue path that names the venue."""
    parts = F.filter(F.split(c, "/"), lambda p: p != "")
    part = lambda i: F.get(parts, F.lit(i))
    first = lambda n: F.concat_ws("/", F.slice(parts, 1, n))
    n, year = F.size(parts), r"^(19|20)\d{2}$"
    return (
        F.when((n >= 3) & (F.lower(part(0)) == "aclweb.org"), first(3))
        .when((n >= 3) & part(2).rlike(year), first(3))
        .when((n >= 4) & part(3).rlike(year), first(4))
        .when((n >= 2) & F.lower(part(1)).isin(*SUBVENUES), first(2))
        .when(n >= 1, part(0))
    )


def venue_of_summary(c: Column) -> Column:
    """Last part of 'authors - venue, year - site' without a year; null with under two parts."""
    parts = F.filter(F.transform(F.split(c, " - "), strip), lambda p: p != "")
    last = F.regexp_replace(F.element_at(parts, -1), YEAR, "")
    return F.when(F.size(parts) >= 2, F.nullif(F.btrim(last, F.lit(" ,")), F.lit("")))


def archive_id(c: Column, host: str = r"[\w.-]+") -> Column:
    """Archive number of a link (abs or pdf) or, failing that, a bare one without its version."""
    link = F.regexp_extract(c, rf"(?i){host}/(?:abs|pdf)/([0-9]+\.[0-9]+)", 1)
    bare = F.regexp_extract(c, r"\b([0-9]{4}\.[0-9]{4,5})(?:v\d+)?\b", 1)
    return F.coalesce(F.nullif(link, F.lit("")), F.nullif(bare, F.lit("")))


def is_pdf_link(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?i)https?://\S+\.pdf(\?.*)?$"), F.lit(False))


def json_in_prose(c: Column) -> Column:
    """The text from the first opening to the last closing bracket of an array, else of an object, if it parses."""
    pick = lambda p: F.try_parse_json(F.nullif(F.regexp_extract(c, p, 0), F.lit("")))
    return F.coalesce(pick(r"\[[\s\S]*\]"), pick(r"\{[\s\S]*\}"))


def object_in_prose(c: Column) -> Column:
    """The text from the first opening to the last closing brace, if it parses."""
    return F.try_parse_json(F.nullif(F.regexp_extract(c, r"\{[\s\S]*\}", 0), F.lit("")))


def list_in_prose(c: Column) -> Column:
    """The text from the first opening to the last closing bracket as an array of variants, if it parses."""
    return F.try_variant_get(F.try_parse_json(F.nullif(F.regexp_extract(c, r"\[[\s\S]*\]", 0), F.lit(""))), "$", "array<variant>")


def score_1_to_5(c: Column) -> Column:
    """Whole number of 1 to 5; a fraction is cut, text must be a whole number; else null."""
    whole = F.when(c.try_cast("string").rlike(r"^\s*[-+]?\d+(\.\d+)?\s*$"), F.regexp_extract(c.try_cast("string"), r"^\s*([-+]?\d+)", 1).try_cast("int"))
    return F.when(whole.between(1, 5), whole)


def non_negative(c: Column) -> Column:
    return F.greatest(F.lit(0), F.coalesce(c.try_cast("int"), F.lit(0)))


def centered_fit(score: Column, ideal: float = 3.0) -> Column:
    return F.when(score.isNotNull(), F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(score - F.lit(ideal)) / F.lit(2.0)))


def similarity_to(value: Column, mean: Column) -> Column:
    """1 at the mean, less by half for every unit away, 0 at least; null where one is null."""
    return F.when(value.isNotNull() & mean.isNotNull(), F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(value - mean) / F.lit(2.0)))


def python_title(c: Column) -> Column:
    """Every run of letters with a capital first and the rest small."""
    spaced = F.regexp_replace(F.lower(c), r"(?U)(?<=[^\p{L}]|^)(?=\p{L})", "\u0001")
    parts = F.transform(F.split(spaced, "\u0001"), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p))))
    return F.array_join(parts, "")


def heading_name(c: Column, joined: dict[str, str] | None = None) -> Column:
    """Heading without its number, with run-together words parted, in title case; 'Untitled Section' if nothing is left."""
    out = F.regexp_replace(squeeze(c), r"^(?:\d+|[A-Z])\s+", "")
    for old, new in (joined or {}).items():
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.btrim(F.regexp_replace(out, SPACE, " "), F.lit(" .:-"))
    return F.when(out == "", "Untitled Section").otherwise(python_title(out))


def joined_lines(lines: Column) -> Column:
    """Lines as one text: blanks squeezed, blank lines left out, a hyphen at a line's end closes the gap."""
    kept = F.filter(F.transform(lines, squeeze), lambda x: x != "")
    return F.aggregate(
        kept, F.lit(""),
        lambda acc, x: F.when(acc == "", x).when(F.endswith(acc, F.lit("-")), F.concat(acc.substr(F.lit(1), F.length(acc) - 1), x)).otherwise(F.concat(acc, F.lit(" "), x)),
    )


def search_variants(query: Column, keywords: Column, most: int = 4) -> Column:
    """The query, and its first keywords as a second query if that differs; blanks left out."""
    second = F.array_join(F.slice(keywords, 1, most), " ")
    a, b = strip(query), strip(second)
    return F.filter(F.array(F.when(a != "", a), F.when((b != "") & (F.lower(b) != F.lower(a)), b)), lambda x: x.isNotNull())
