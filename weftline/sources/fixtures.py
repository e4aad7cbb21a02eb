"""Company-shaped views of the driver's tables; plans/oracle.py has the same mapping in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def comp_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as companies; every seventh lacks a domain and every fifth a city, for the null rules."""
    p = table(spark, sf_dir, "part")
    brand = F.lower(F.col("p_brand"))
    return p.select(
        F.col("p_partkey").cast("long").alias("company_id"),
        F.lower("p_name").alias("company_name"),
        F.when(F.col("p_partkey") % 7 == 0, "").otherwise(F.concat(F.replace(brand, F.lit("#"), F.lit("")), F.lit("-"), F.col("p_size").cast("string"), F.lit(".com"))).alias("domain_name"),
        F.when(F.col("p_partkey") % 5 != 0, F.lower("p_type")).alias("city"),
        brand.alias("final_country"),
        F.col("p_size").cast("int").alias("current_employee_estimate"),
        F.floor("p_retailprice").cast("int").alias("total_employee_estimate"),
    )


def _bronze(df: DataFrame, **columns) -> DataFrame:
    null = {"year founded": "int", "current employee estimate": "int", "total employee estimate": "int"}
    names = ["company_id", "name", "domain", "year founded", "industry", "size range", "locality", "country", "linkedin url", "current employee estimate", "total employee estimate"]
    return df.select(*[columns.get(n.replace(" ", "_"), F.lit(None).cast(null.get(n, "string"))).alias(n) for n in names])


def bronze_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return _bronze(
        table(spark, sf_dir, "pages"),
        company_id=F.col("page_id").cast("long"),
        name=F.concat(F.lit(" Page "), F.col("page_id").cast("string"), F.lit(" ")),
        domain=url,
        industry=F.lit("N/A"),
        size_range=F.lit("n/a"),
        locality=F.concat(F.lit("Town , "), F.substring(url, 1, 5), F.lit(", CA ")),
        linkedin_url=F.concat(F.lit("HTTPS://uk.linkedin.com/company/"), F.col("page_id").cast("string"), F.lit("/")),
    )


def bronze_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return _bronze(
        joined,
        company_id=F.col("c_custkey").cast("long"),
        name=F.col("c_name"),
        industry=F.col("c_mktsegment"),
        locality=F.concat(F.col("c_mktsegment"), F.lit(", ,"), F.col("n_name")),
        country=F.when(F.col("c_custkey") % 3 == 0, F.col("n_name")).otherwise(F.lit(" null ")),
        total_employee_estimate=F.floor("c_acctbal").cast("int"),
    )
