"""Cleaning: one raw company row in, one normalised row out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as t


def clean_companies(raw: DataFrame) -> DataFrame:
    """Projection only, so it fuses with the scan. An absent domain or profile address becomes ''; size_range keeps its literal text."""
    col = {n: t.blank_to_null(F.col(f"`{n}`")) for n in ("name", "domain", "industry", "linkedin url", "locality", "size range")}
    text = {n: t.null_literals(c) for n, c in col.items()}
    country = t.null_literals(t.blank_to_null(F.lower(F.col("country"))))
    part = lambda n: F.nullif(t.nth_part(text["locality"], n), F.lit(""))
    return raw.select(
        F.col("company_id").cast("long").alias("company_id"),
        F.lower(text["name"]).alias("company_name"),
        t.domain(text["domain"]).alias("domain_name"),
        F.lower(text["industry"]).alias("industry"),
        t.linkedin(text["linkedin url"]).alias("linkedin_url"),
        F.col("`year founded`").alias("year_founded"),
        col["size range"].alias("size_range"),
        F.col("`current employee estimate`").alias("current_employee_estimate"),
        F.col("`total employee estimate`").alias("total_employee_estimate"),
        F.lower(part(1)).alias("city"),
        F.lower(part(2)).alias("state"),
        F.lower(F.coalesce(country, part(3))).alias("final_country"),
    )


def scrub_number(name: str):
    """Digits of a text as an integer, null where there are none."""
    return F.expr(f"try_cast(regexp_replace(`{name}`, '[^0-9]', '') AS INT)")


def count_audit(before: DataFrame, after: DataFrame) -> dict:
    n, m = before.count(), after.count()
    return {"rows_in": n, "rows_out": m, "equal": n == m}
