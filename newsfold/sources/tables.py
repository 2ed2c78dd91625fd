"""Readers for the input tables (parquet; column pruning and filter pushdown
are left to the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """In a local session, spread a scan that yields fewer partitions than
    cores (a small file with one row group) before CPU-heavy text work.  On a
    cluster the scan's splits (``spark.sql.files.maxPartitionBytes``) are left
    as they are."""
    try:
        if not df.sparkSession.sparkContext.master.startswith("local["):
            return df
        cores = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        return df
    return df.repartition(cores) if parts < cores else df


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id long, url string, html string"""
    return spread(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id long, text string, lang string, source string, n_chars long"""
    return spread(read_table(spark, sf_dir, "documents"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id long, ts timestamp_ntz, user_id long, event_type string,
    value double, props string"""
    return read_table(spark, sf_dir, "events")
