"""PL*: the whole pipeline, and counts of its stages."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.operators import cleaning, generation, quality, repair, segmenting, selection


def materialized(df: DataFrame) -> DataFrame:
    """df written to the checkpoint folder of the session (a temporary one only in local mode where none is set), so that
    later stages are planned on its columns and not on the expressions behind them."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="inkmill-"))
    return df.checkpoint()


def run(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", clean: bool = True) -> dict[str, DataFrame]:
    """PL1: stages cleaned, segments, pairs, fixed, scored, selected, final.

    Segments, pairs and repaired pairs are materialized.

    ``clean=False`` skips the cleaning stage (documents go to segmentation as they are).
    """
    slim = docs.select(id_col, text_col).where(F.col(text_col).isNotNull())
    cleaned = cleaning.clean_documents(slim, id_col, text_col) if clean else slim
    segs = materialized(segmenting.segments(cleaned, id_col, text_col))
    pairs = generation.sample_questions(segs, [id_col, "segment_no"])
    pairs = materialized(pairs)
    pairs = pairs.where(generation.is_sound(F.col("user"), F.col("assistant")))
    fixed = materialized(repair.fix_pairs(pairs).withColumnsRenamed({"user": "question", "assistant": "answer"}))
    scored = quality.evaluate(quality.with_duplicates(fixed, [id_col, "segment_no", "dim_no", "tmpl_no"]))
    order = [id_col, "segment_no", "dim_no", "tmpl_no"]
    selected = selection.balanced(scored, order)
    return {"cleaned": cleaned, "segments": segs, "pairs": pairs, "fixed": fixed, "scored": scored, "selected": selected, "final": selection.final_list(selected, order)}


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """PL3: stage, n."""
    out = None
    for name, df in stages.items():
        row = df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


def top_topics(pairs: DataFrame, size: int = 10) -> DataFrame:
    """PL6: the most frequent topics, missing ones as 未知主题, ties by topic."""
    return pairs.groupBy(F.coalesce("topic", F.lit("未知主题")).alias("topic")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "topic").limit(size)


def dimension_distribution(pairs: DataFrame) -> DataFrame:
    """PL7."""
    return pairs.groupBy(F.coalesce("dimension", F.lit("未知维度")).alias("dimension")).agg(F.count(F.lit(1)).alias("n"))


def report_digest(reports: DataFrame, by: str) -> DataFrame:
    """PL4: of each report the pairs, average score, excellent ones and the two kinds of mismatch."""
    return reports.select(by, "total_pairs", "average_score", "excellent", "question_answer_mismatch", "topic_mismatch")


def cleaning_digest(cleaned: DataFrame, id_col: str) -> DataFrame:
    """PL5."""
    return cleaned.select(
        id_col, F.size("titles").alias("titles"), F.size("figures").alias("figures"), F.size("list_items").alias("list_items"), "removed_references", F.size("terms").alias("terms"), "redundant"
    )
