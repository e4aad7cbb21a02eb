"""Ingest of company files and table input and output."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: The columns of a company file, in order; the first has a blank header.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("company_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("year founded", T.IntegerType()),
        T.StructField("industry", T.StringType()),
        T.StructField("size range", T.StringType()),
        T.StructField("locality", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("linkedin url", T.StringType()),
        T.StructField("current employee estimate", T.IntegerType()),
        T.StructField("total employee estimate", T.IntegerType()),
    ]
)


def expand_zip(archive: str, target: str) -> list[str]:
    """Unpack on the driver into a folder that the executors share; the CSV files found, at any depth."""
    if not Path(archive).is_file():
        raise FileNotFoundError(archive)
    with zipfile.ZipFile(archive) as z:
        z.extractall(target)
    found = sorted(str(p) for p in Path(target).rglob("*.csv"))
    if not found:
        raise FileNotFoundError(f"no CSV file in {archive}")
    return found


def read_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Explicit schema, no inference pass; a malformed number stops the load."""
    return spark.read.schema(RAW_SCHEMA).option("header", True).option("mode", "FAILFAST").option("enforceSchema", True).csv(paths)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def save_table(df: DataFrame, name: str) -> None:
    """Create or replace a managed table, with its database."""
    if "." in name:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def drop_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def register(spark: SparkSession, rows, schema, view: str) -> DataFrame:
    df = spark.createDataFrame(rows, schema)
    df.createOrReplaceTempView(view)
    return df
