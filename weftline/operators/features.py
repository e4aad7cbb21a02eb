"""The 17 features of a pair: 13 numbers and 4 texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as t

NUMERIC = ["domain_exact", "country_exact", "city_exact", "name_exact", "name_compact_exact", "name_prefix4_eq", "name_prefix6_eq", "emp_cur_absdiff", "emp_cur_reldiff", "emp_tot_absdiff", "emp_tot_reldiff", "both_have_domain", "both_have_name"]
CATEGORICAL = ["country_a", "country_b", "city_a", "city_b"]


def _side(companies: DataFrame, s: str, empty_domain_is_null: bool) -> DataFrame:
    domain = F.col("domain_name")
    return companies.select(
        F.col("company_id").cast("long").alias(f"company_id_{s}"),
        F.col("company_name").alias(f"name_{s}"),
        (F.nullif(domain, F.lit("")) if empty_domain_is_null else domain).alias(f"domain_{s}"),
        F.col("final_country").alias(f"country_{s}"),
        F.col("city").alias(f"city_{s}"),
        t.compact(F.col("company_name")).alias(f"compact_{s}"),
        F.col("current_employee_estimate").alias(f"cur_{s}"),
        F.col("total_employee_estimate").alias(f"tot_{s}"),
    )


def _equal(name: str) -> Column:
    """0 where a is null, null where only b is: the asymmetry is part of the feature."""
    a, b = F.col(f"{name}_a"), F.col(f"{name}_b")
    return (a.isNotNull() & (a == b)).cast("int")


def _prefix(n: int) -> Column:
    a, b = F.col("compact_a"), F.col("compact_b")
    return F.when(a.isNotNull() & b.isNotNull() & (F.left(a, F.lit(n)) == F.left(b, F.lit(n))), 1).otherwise(0)


def _absdiff(name: str) -> Column:
    return F.abs(F.coalesce(F.col(f"{name}_a"), F.lit(0)) - F.coalesce(F.col(f"{name}_b"), F.lit(0)))


def _reldiff(name: str) -> Column:
    top = F.greatest(F.coalesce(F.col(f"{name}_a"), F.lit(0)), F.coalesce(F.col(f"{name}_b"), F.lit(0)))
    return F.when(top > 0, _absdiff(name).cast("double") / top.cast("double"))


def pair_features(pairs: DataFrame, companies: DataFrame, empty_domain_is_null: bool = False) -> DataFrame:
    """Two equi-joins; pairs with an unknown id drop out."""
    both = pairs.join(_side(companies, "a", empty_domain_is_null), "company_id_a").join(_side(companies, "b", empty_domain_is_null), "company_id_b")
    have = lambda n: (F.col(f"{n}_a").isNotNull() & F.col(f"{n}_b").isNotNull()).cast("int")
    return both.select(
        "company_id_a",
        "company_id_b",
        _equal("domain").alias("domain_exact"),
        _equal("country").alias("country_exact"),
        _equal("city").alias("city_exact"),
        _equal("name").alias("name_exact"),
        _equal("compact").alias("name_compact_exact"),
        _prefix(4).alias("name_prefix4_eq"),
        _prefix(6).alias("name_prefix6_eq"),
        _absdiff("cur").alias("emp_cur_absdiff"),
        _reldiff("cur").alias("emp_cur_reldiff"),
        _absdiff("tot").alias("emp_tot_absdiff"),
        _reldiff("tot").alias("emp_tot_reldiff"),
        have("domain").alias("both_have_domain"),
        have("name").alias("both_have_name"),
        *CATEGORICAL,
    )
