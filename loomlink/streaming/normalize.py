"""Normalization of arriving raw files. Only this stage is record-local; retrieval, weights and assignment are global."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from loomlink.functions.text import normalize_records
from loomlink.schemas import RAW


def normalize_stream(spark: SparkSession, raw_dir: str, out_dir: str, checkpoint: str) -> StreamingQuery:
    """Reads each new Parquet file of raw records once and appends its normalized records."""
    rows = spark.readStream.schema(RAW).parquet(raw_dir)
    writer = normalize_records(rows).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(out_dir)
