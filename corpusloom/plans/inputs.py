"""Inputs the query set derives from the driver's tables (see README, table mapping)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import text_lines
from corpusloom.sources.testdata import table


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> one row per line: (doc_id, line_no, line)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select(
        "doc_id", F.posexplode(text_lines(F.col("text"))).alias("line_no", "line")
    ).withColumn("line_no", F.col("line_no").cast("bigint"))


def bench_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return b.select(
        F.col("item_id").alias("doc_id"), F.posexplode(text_lines(F.col("text"))).alias("line_no", "line")
    ).withColumn("line_no", F.col("line_no").cast("bigint"))
