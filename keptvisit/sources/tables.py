"""Typed readers: parquet folders, JDBC tables split by a key, and CSV extracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int,
    **options: str,
) -> DataFrame:
    """A database table read by many tasks, each a slice of `key` between low and high."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high,
                 numPartitions=parts, **options)
        .load()
    )


def read_extract(
    spark: SparkSession, path: str | list[str], schema: StructType | str, null_token: str = "NULL",
) -> DataFrame:
    """A CSV extract with a header, whose missing values are written as `null_token`."""
    return spark.read.csv(path, schema=schema, header=True, nullValue=null_token)


def write_extract(frame: DataFrame, path: str, null_token: str = "NULL") -> None:
    frame.write.mode("overwrite").csv(path, header=True, nullValue=null_token)


def stack_sites(
    extracts: list[DataFrame], supplement: DataFrame, key: str, replaced: list[str],
    distinct: bool = False,
) -> DataFrame:
    """Site extracts under each other, the `replaced` columns taken from the supplement.

    With `distinct`, an extract that is listed twice counts once.
    """
    rows = reduce(DataFrame.unionByName, extracts).drop(*replaced)
    if distinct:
        rows = rows.dropDuplicates()
    return rows.join(supplement.select(key, *replaced), key, "left")


def save_snapshot(frame: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result and go on from the written files."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.parquet(path)


def shift_ids(frame: DataFrame, fold: int, offset: int, key: str = "person_id") -> DataFrame:
    """One fold with its person ids moved by a secret offset, for sharing as a sample."""
    return frame.filter(F.col("fold_id") == fold).withColumn(key, F.col(key) + offset)
