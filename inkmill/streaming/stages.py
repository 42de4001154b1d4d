"""The row-local stages over streams: they keep no state, so each works on readStream as it does on a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.functions.text import final_formatting, remove_addresses
from inkmill.operators import segmenting


def segment_stream(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Address removal, formatting and segmentation of a stream of documents (deduplication of sentences, which needs all
    sentences of a document side by side, is left to the batch stage)."""
    cleaned = remove_addresses(docs, text_col).withColumn(text_col, final_formatting(F.col(text_col)))
    return segmenting.segments(cleaned, id_col, text_col)


def windowed_counts(stream: DataFrame, time_col: str, key: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Records by key and event-time window, with a watermark for late loads."""
    return stream.withWatermark(time_col, late).groupBy(F.window(time_col, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), key, "n")
