"""One record for each entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve(entities: DataFrame, companies: DataFrame) -> DataFrame:
    """Most frequent values, ties to the smallest; the domain of the smallest id that has one."""
    joined = entities.join(companies.withColumn("company_id", F.col("company_id").cast("long")), "company_id")
    usual = lambda c: F.mode(c, deterministic=True)
    return joined.groupBy("entity_id").agg(
        F.count("*").alias("sources_count"),
        F.min_by("domain_name", F.when(F.col("domain_name").isNotNull(), F.col("company_id"))).alias("domain"),
        usual(F.col("final_country")).alias("country"),
        usual(F.col("city")).alias("city"),
        usual(F.lower("company_name")).alias("name"),
        F.round(F.avg("total_employee_estimate"), 1).alias("employees_avg"),
    )
