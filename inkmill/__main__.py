"""IO22: the stages from the command line: ``python -m inkmill STAGE INPUT OUTPUT``; run with spark-submit on a cluster."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.operators import cleaning, generation, quality, repair, segmenting, selection
from inkmill.plans import pipeline
from inkmill.sources import io

PAIR_COLUMNS = ("system", "user", "assistant", "topic", "dimension", "difficulty", "segment_id")


def _texts(spark: SparkSession, path: str) -> DataFrame:
    """Documents of text files, or of PDF files where the name says so."""
    if path.lower().endswith(".pdf"):
        return io.join_pages(io.read_pdfs(spark, path)).withColumnRenamed("doc_id", "path")
    return io.read_texts(spark, path)


def _questions(spark: SparkSession, path: str) -> DataFrame:
    chat = path.rstrip("/").endswith(".jsonl")
    df = io.read_records(spark, path, io.CHAT if chat else io.PAIR)
    return quality.chat_to_pairs(df) if chat else df.withColumnsRenamed({"user": "question", "assistant": "answer"})


def extract(spark: SparkSession, a: argparse.Namespace) -> None:
    _texts(spark, a.input).select("text").write.mode("overwrite").text(a.output)


def clean(spark: SparkSession, a: argparse.Namespace) -> None:
    done = pipeline.materialized(cleaning.cleaning_report(cleaning.clean_documents(_texts(spark, a.input), "path", "text"), a.input, a.output))
    done.select("text").write.mode("overwrite").text(a.output)
    io.write_lines(done, F.to_json("report"), a.output.rstrip("/") + "_report")


def segment(spark: SparkSession, a: argparse.Namespace) -> None:
    pieces = segmenting.segments(_texts(spark, a.input), "path", "text", a.size, a.overlap)
    io.write_array(pieces.select((F.col("segment_no") + 1).alias("segment_id"), "content"), a.output)


def generate(spark: SparkSession, a: argparse.Namespace) -> None:
    made = generation.sample_questions(io.read_records(spark, a.input, io.SEGMENT), ["segment_id"])
    sound = pipeline.materialized(made.where(generation.is_sound(F.col("user"), F.col("assistant"))))
    io.write_array(sound.select(*PAIR_COLUMNS), a.output)
    io.write_lines(sound, io.chat_lines(sound), a.output.rstrip("/") + "_chat")


def fix(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.input.rstrip("/").endswith(".jsonl"):
        df = repair.fix_chat(io.read_records(spark, a.input, io.CHAT))
        io.write_lines(df, F.to_json(F.struct("*")), a.output)
    else:
        io.write_array(repair.fix_pairs(io.read_records(spark, a.input, io.PAIR)).drop("fixed"), a.output)


def evaluate(spark: SparkSession, a: argparse.Namespace) -> None:
    order = ["question", "answer"]  # files have no row numbers: a record is said before if its texts sort before
    scored = pipeline.materialized(quality.evaluate(quality.with_duplicates(_questions(spark, a.input), order)))
    io.write_lines(quality.report(scored.withColumn("_file", F.lit(a.input)), ["_file"]), io.report_lines(F.col("_file"), quality.COUNTERS), a.output.rstrip("/") + "_report")
    best = selection.final_list(selection.balanced(scored, order, a.threshold), order, a.top)
    io.write_array(best.select(F.col("question").alias("user"), F.col("answer").alias("assistant"), F.col("total_score").alias("quality_score"), "topic", "dimension", "difficulty"), a.output)


def whole(spark: SparkSession, a: argparse.Namespace) -> None:
    """All stages in order; a stage that fails ends the run, what was written before it stays."""
    root = io.first_folder(spark, a.output.rstrip("/"), "output")
    place = {x: f"{root}/{x}" for x in ("enhanced", "segments.json", "pairs.json", "fixed.json", "best.json")}
    chain = [("clean", clean, a.input, "enhanced"), ("segment", segment, place["enhanced"], "segments.json"), ("generate", generate, place["segments.json"], "pairs.json"), ("fix", fix, place["pairs.json"], "fixed.json"), ("evaluate", evaluate, place["fixed.json"], "best.json")]
    for name, stage, source, target in chain:
        if a.skip_existing and io.exists(spark, place[target]):
            continue
        try:
            stage(spark, argparse.Namespace(**vars(a) | {"input": source, "output": place[target]}))
        except Exception as e:
            raise SystemExit(f"stage {name} failed: {e}") from e


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="inkmill", description="document-to-QA data preparation")
    stages = {"extract": extract, "clean": clean, "segment": segment, "generate": generate, "fix": fix, "evaluate": evaluate, "run": whole}
    parser.add_argument("stage", choices=stages)
    parser.add_argument("input")
    parser.add_argument("output", nargs="?", default="output")
    parser.add_argument("--size", type=int, default=segmenting.SIZE)
    parser.add_argument("--overlap", type=int, default=segmenting.OVERLAP)
    parser.add_argument("--threshold", type=float, default=85.0)
    parser.add_argument("--top", type=int, default=200)
    parser.add_argument("--skip-existing", action="store_true")
    a = parser.parse_args(argv)
    stages[a.stage](SparkSession.builder.appName("inkmill").getOrCreate(), a)


if __name__ == "__main__":
    main(sys.argv[1:])
