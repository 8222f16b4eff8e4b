"""Scoring of files as they land in a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.corpus import split_records


def score_stream(spark: SparkSession, folder: str, schema: str, score: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, how: str = "parquet"):
    """Starts a stream that scores each file of a folder once and adds the rows to the sink as Parquet, a folder batch=<number> for each batch; stateless, so late files need no watermark.

    A batch that is run again, after a restart before it was marked as done, has the same number and the same files, and replaces what it wrote; so rows are never there twice.
    how: `parquet` files of the schema, or `fasta`: records (fragment_id, header, sequence, bp), whose schema is given by the format."""
    if how == "fasta":
        rows = split_records(spark.readStream.text(folder, lineSep="\n>"))
    else:
        rows = spark.readStream.schema(schema).parquet(folder)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return score(rows).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def scored(spark: SparkSession, sink: str) -> DataFrame:
    """The rows that score_stream has added to a sink."""
    return spark.read.parquet(sink).drop("batch")
