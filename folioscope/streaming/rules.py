"""Rules on a stream of documents: the rules hold no state, so they run unchanged on every batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import rules


def issue_stream(spark: SparkSession, path: str, schema: str = "doc_id long, text string") -> DataFrame:
    """All issues of the documents that arrive as Parquet files in ``path``."""
    return rules.issues(spark.readStream.schema(schema).parquet(path), "doc_id")
