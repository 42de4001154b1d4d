"""IO*: readers and writers of the pipeline's artefacts."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions.rules import SYSTEM_PROMPT

PAIR = "system string, user string, assistant string, topic string, dimension string, difficulty string, segment_id int"
CHAT = "conversations array<struct<role:string,content:string>>, segment_id int, dimension string, difficulty string, topic string"
SEGMENT = "segment_id int, content string"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """IO4: one row a file: path, text."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def read_pdfs(spark: SparkSession, path: str) -> DataFrame:
    """IO1-2: doc_id (path), page_no, text of PDF pages, where the optional parser ``pypdf`` is installed."""
    import importlib.util

    if importlib.util.find_spec("pypdf") is None:
        raise NotImplementedError("reading PDF needs the optional package pypdf; give page texts instead")

    def pages(batches):
        import io

        import pandas as pd
        from pypdf import PdfReader

        for b in batches:
            rows = [(p, i, (page.extract_text() or "").strip()) for p, c in zip(b["path"], b["content"]) for i, page in enumerate(PdfReader(io.BytesIO(c)).pages, 1)]
            yield pd.DataFrame(rows, columns=["doc_id", "page_no", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(pages, "doc_id string, page_no int, text string")


def join_pages(pages: DataFrame) -> DataFrame:
    """IO3: doc_id, text: stripped pages in order, each after its page mark."""
    marked = F.concat(F.lit("\n\n=== 第 "), F.col("page_no"), F.lit(" 页 ===\n\n"), F.regexp_replace(F.coalesce("text", F.lit("")), r"(?Ud)^\s+|\s+$", ""))
    ordered = F.array_sort(F.collect_list(F.struct("page_no", marked.alias("t"))))
    return pages.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "").alias("text"))


def read_records(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """IO6, 8, 9, 11: .jsonl files line by line without malformed lines; other files as JSON arrays, a malformed one
    empty, or an error if strict."""
    reader = spark.read.schema(schema)
    if path.rstrip("/").endswith(".jsonl"):
        return reader.option("mode", "DROPMALFORMED").json(path)
    return reader.option("multiLine", True).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_in_order(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """IO18: several files with file_ord; missing ones are skipped, missing columns null."""
    there = [(i, p) for i, p in enumerate(paths, 1) if exists(spark, p)]
    parts = [read_records(spark, p, schema).withColumn("file_ord", F.lit(i)) for i, p in there]
    if not parts:
        return spark.createDataFrame([], schema).withColumn("file_ord", F.lit(0))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def conversations(question: Column, answer: Column, system: Column | None = None) -> Column:
    """IO12: the three turns of a chat record."""
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(turn("system", F.lit(SYSTEM_PROMPT) if system is None else system), turn("user", question), turn("assistant", answer))


def chat_lines(df: DataFrame, question: str = "user", answer: str = "assistant", extra: tuple[str, ...] = ("segment_id", "dimension", "difficulty", "topic")) -> Column:
    """IO10, 13: a JSON line a record; null metadata is left out."""
    return F.to_json(F.struct(conversations(F.col(question), F.col(answer)).alias("conversations"), *[F.col(c) for c in extra if c in df.columns]))


def flat_lines(df: DataFrame, columns: tuple[str, ...]) -> Column:
    """IO14."""
    return F.to_json(F.struct(*[F.col(c) for c in columns if c in df.columns]))


def report_lines(filename: Column, counters: tuple[str, ...]) -> Column:
    """IO16: a quality report in its nested shape: filename, total_pairs, average_score, score_distribution, common_issues."""
    distribution = F.struct(*[F.col(c) for c in ("excellent", "good", "fair", "poor")])
    return F.to_json(F.struct(filename.alias("filename"), "total_pairs", "average_score", distribution.alias("score_distribution"), F.struct(*[F.col(c) for c in counters]).alias("common_issues")))


def write_array(df: DataFrame, path: str, indent: int = 2) -> None:
    """IO7: the records as JSON arrays, one a part file, indented; each part is written as it is made, never a whole table at once.

    An empty part gives an empty array, or an empty file where Spark plans no task for it; both are read as no records.
    """
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pad = None, " " * indent  # a record waits for the next one, which puts a comma after it
        for batch in batches:
            out = []
            for line in batch.column(0).to_pylist():
                out.append("[" if held is None else held + ",")
                held = pad + json.dumps(json.loads(line), ensure_ascii=False, indent=indent).replace("\n", "\n" + pad)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]"] if held is None else [held, "]"])], names=["value"])

    df.select(record.alias("value")).mapInArrow(parts, "value string").write.mode("overwrite").text(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def first_folder(spark: SparkSession, *folders: str) -> str:
    """IO17: the first of the folders that can be made or is there; the last one is the fallback."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders[:-1]:
        try:
            if fs.Path(folder).getFileSystem(conf).mkdirs(fs.Path(folder)):
                return folder
        except Py4JJavaError:
            continue
    return folders[-1]


def write_lines(df: DataFrame, line: Column, path: str, skip_existing: bool = False) -> None:
    """IO5, 7, 10, 15-17, 19: text lines in parallel part files; skip_existing leaves what is there."""
    df.select(line.alias("value")).write.mode("ignore" if skip_existing else "overwrite").text(path)


def prefer(enhanced: DataFrame, processed: DataFrame, key: str, text: str = "text") -> DataFrame:
    """IO20: the enhanced text of each document, else the processed one."""
    e = enhanced.select(key, F.col(text).alias("_enhanced"))
    return processed.join(e, key, "left").withColumn(text, F.coalesce("_enhanced", text)).drop("_enhanced")


def improved_name(path: str, suffix: str = "_improved") -> str:
    """IO21: the name with a suffix before its extension."""
    stem, dot, ext = path.rpartition(".")
    return f"{stem}{suffix}{dot}{ext}" if dot and "/" not in ext else path + suffix
