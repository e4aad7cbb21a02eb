"""Text normalisation as Column expressions; all of it stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for a missing value.
NULL_LITERALS = ["nan", "null", "n/a"]


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def null_literals(c: Column) -> Column:
    return F.when(~F.lower(c).isin(NULL_LITERALS), c)


def domain(c: Column) -> Column:
    """Scheme, a leading www. and trailing slashes go; path and query stay; a missing value is ''."""
    out = F.lower(F.coalesce(c, F.lit("")))
    for pattern in (r"^https?://", r"^www\.", r"/+$"):
        out = F.regexp_replace(out, pattern, "")
    return out


def linkedin(c: Column) -> Column:
    """A profile address without scheme, host prefix and final slashes; a missing value is ''."""
    bare = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"^https?://", "")
    hosted = (
        F.when(bare.startswith("linkedin.com/") | bare.startswith("www.linkedin.com/"), F.regexp_replace(bare, r"^www\.", ""))
        .when(bare.contains("linkedin.com/"), F.regexp_extract(bare, r"(linkedin\.com/.*)$", 1))
        .otherwise(F.nullif(bare, F.lit("")))
    )
    return F.coalesce(F.regexp_replace(hosted, r"/+$", ""), F.split_part(bare, F.lit("?"), F.lit(1)))


def key(c: Column) -> Column:
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def spaced(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^a-z0-9\s]", "")


def compact(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "")


def nth_part(c: Column, n: int) -> Column:
    return F.trim(F.split_part(c, F.lit(","), F.lit(n)))
