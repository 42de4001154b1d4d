"""Sources, streaming, the whole pipeline and the registered queries against their SQL."""

import json
import os

import pytest
from pyspark.sql import functions as F

from inkmill import catalog
from inkmill.operators import generation
from inkmill.plans import pipeline
from inkmill.sources import io
from inkmill.streaming import stages

SF = "/root/testdata/sf0.001"
CHECKED = [
    "clean_text_gen", "clean_text_fix", "line_kind_counts", "terminology_counts", "sentence_dedup", "final_formatting", "segment_filter", "topic_valid", "answer_sentences", "topic_mode", "validate_pairs",
    "pair_statistics", "fix_question", "fix_answer", "validate_fixed", "duplicates", "keyword_set", "evaluate_pairs", "quality_report", "issue_counts", "select_balanced", "page_join", "dimension_dist",
    "line_structure", "list_regions", "remove_redundant", "sentence_split", "chat_jsonl", "flat_json", "topic_extract", "topic_relation", "answer_greedy", "template_expand", "question_sample", "repair_lookup_join",
    "topic_consistency", "fix_pairs", "fix_chat", "url_remove_basic", "report_digest", "report_json", "final_top200",
]


def test_json_round_trip(spark, tmp_path):
    qa = spark.createDataFrame([("s", "问？", "答。", "t", "d", "e", 1), ("s", "问2？", "答2。", None, "d", "e", None)], io.PAIR)
    io.write_lines(qa, io.chat_lines(qa), str(tmp_path / "chat.jsonl"))
    io.write_lines(qa.where("false"), io.chat_lines(qa), str(tmp_path / "chat.jsonl"), skip_existing=True)
    back = io.read_records(spark, str(tmp_path / "chat.jsonl"), io.CHAT)
    assert back.count() == 2 and {r.conversations[1].content for r in back.collect()} == {"问？", "问2？"}
    (tmp_path / "bad.jsonl").write_text('{"user": "a"}\nnot json\n{"user": "b"}\n', encoding="utf-8")
    assert io.read_records(spark, str(tmp_path / "bad.jsonl"), io.PAIR).count() == 2
    (tmp_path / "all.json").write_text(json.dumps([{"user": "a"}, {"user": "b"}]), encoding="utf-8")
    got = io.read_in_order(spark, [str(tmp_path / "none.json"), str(tmp_path / "all.json"), str(tmp_path / "bad.jsonl")], io.PAIR)
    assert [(r.file_ord, r.n) for r in got.groupBy("file_ord").agg(F.count("*").alias("n")).orderBy("file_ord").collect()] == [(2, 2), (3, 2)]
    assert io.improved_name("a/b.json") == "a/b_improved.json"


def test_pages_and_preference(spark):
    pages = spark.createDataFrame([("d", 2, " 乙 "), ("d", 1, "甲"), ("d", 3, None)], "doc_id string, page_no int, text string")
    joined = io.join_pages(pages)
    assert joined.first().text == "\n\n=== 第 1 页 ===\n\n甲\n\n=== 第 2 页 ===\n\n乙\n\n=== 第 3 页 ===\n\n"
    better = spark.createDataFrame([("d", "好")], "doc_id string, text string")
    assert io.prefer(better, joined, "doc_id").first().text == "好"
    assert io.prefer(better.where("false"), joined, "doc_id").first().text.startswith("\n\n===")


def test_json_arrays_and_folders(spark, tmp_path):
    df = spark.createDataFrame([(i, "文本\n\"x\"" if i else None) for i in range(5)], "a int, b string").coalesce(1)
    io.write_array(df, str(tmp_path / "x.json"))
    (part,) = (tmp_path / "x.json").glob("part-*")
    raw = part.read_text(encoding="utf-8")
    assert json.loads(raw) == [{"a": i, "b": "文本\n\"x\"" if i else None} for i in range(5)] and '\n  {\n    "a": 0,' in raw
    assert io.read_records(spark, str(tmp_path / "x.json"), "a int, b string", strict=True).count() == 5
    io.write_array(df.where("false"), str(tmp_path / "none.json"))
    assert io.read_records(spark, str(tmp_path / "none.json"), "a int, b string", strict=True).count() == 0
    (tmp_path / "file").write_text("")
    assert io.first_folder(spark, str(tmp_path / "file" / "no"), str(tmp_path / "yes")) == str(tmp_path / "yes") and io.first_folder(spark, str(tmp_path / "new"), "other") == str(tmp_path / "new")


def test_command_line(spark, tmp_path):
    from inkmill.__main__ import main

    (tmp_path / "in.txt").write_text("1. 仓储概述\n仓库管理系统是一种平台。" + "".join(f"它可以管理第{i}类库存与作业流程。" for i in range(60)), encoding="utf-8")
    main(["run", str(tmp_path / "in.txt"), str(tmp_path / "out")])
    assert {p.name for p in (tmp_path / "out").iterdir()} >= {"enhanced", "enhanced_report", "segments.json", "pairs.json", "pairs.json_chat", "fixed.json", "best.json", "best.json_report"}
    assert io.read_records(spark, str(tmp_path / "out" / "fixed.json"), io.PAIR).count() >= 3
    main(["run", str(tmp_path / "in.txt"), str(tmp_path / "out"), "--skip-existing"])
    with pytest.raises(SystemExit, match="stage clean failed"):
        main(["run", str(tmp_path / "missing.txt"), str(tmp_path / "out2")])


def test_one_segment_holding_half_of_the_rows(spark):
    # null and hot keys: nothing but counts is gathered by segment, and rows that need no change are not joined
    rows = [(i, 1 if i % 2 else None if i % 3 else i, ["自动驾驶", "责任归属分析", None][i % 3], "问题到底是什么呢，请说明？", "自动驾驶" + "长" * 120 if i % 5 else "短") for i in range(600)]
    qa = spark.createDataFrame(rows, "qa_id int, segment_id int, topic string, user string, assistant string").withColumn("dimension", F.lit("释义类"))
    out = generation.consistent_topics(qa, "segment_id", F.col("assistant"))
    main = {None: None} | {r.segment_id: r.topic for r in generation.main_topics(qa, "segment_id").collect()}
    want = {q: "自动驾驶技术" if s and t and t != main[s] and "责任归属" in t and "自动驾驶" in a else t for q, s, t, _, a in rows}
    assert {r.qa_id: r.topic for r in out.collect()} == want and out.columns == qa.columns
    segs = spark.createDataFrame([(1, "区块链是指一种分布式账本。" * 10), (1, "区块链是指一种分布式账本。" * 10)], "segment_id int, content string")
    fixed = {r.qa_id: r.fixed for r in generation.repair_pairs(qa, segs, "segment_id", "content").collect()}
    assert fixed == {q: s == 1 and a == "短" for q, s, _, _, a in rows}


def test_stream_equals_batch(spark, tmp_path):
    docs = spark.createDataFrame([(1, "句子。" * 400), (2, None)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "in"))
    q = stages.segment_stream(spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("seg").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    batch = stages.segment_stream(docs)
    assert sorted(map(tuple, spark.table("seg").collect())) == sorted(map(tuple, batch.collect()))


def test_pipeline(spark):
    text = "1. 仓储概述\n仓库管理系统是一种平台。" + "".join(f"它可以管理第{i}类库存与作业流程。" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    st = pipeline.run(docs)
    assert st["segments"].count() > 0 and st["final"].count() <= st["selected"].count() <= st["scored"].count()
    empty = pipeline.run(docs.where("false"), clean=False)
    assert empty["final"].count() == 0


def test_stage_counts_are_those_of_the_whole_pipeline(spark, tmp_path):
    line = "1. 国际物流的清关步骤：首先提交单据，其次核对清单，最后放行货物，这些步骤能够缩短通关时间。"
    rows = [(i, "\n".join([f"第{i}章 跨境物流", *[line] * 12, "联系地址：北京市朝阳区某路 1 号", line])) for i in range(3)]
    spark.createDataFrame([*rows, (9, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    st = pipeline.run(spark.read.parquet(str(tmp_path / "documents.parquet")))
    got = {r.stage: r.n for r in catalog.stage_counts(spark, str(tmp_path)).collect()}
    assert got == {k: df.count() for k, df in st.items()}
    assert list(got) == ["cleaned", "segments", "pairs", "fixed", "scored", "selected", "final"] and got["cleaned"] == 3


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", CHECKED)
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    df = catalog.queries()[name](spark, SF)
    got = con.execute(catalog.oracle_sql()[name])
    cols = [c[0] for c in got.description]
    assert sorted(cols) == sorted(df.columns)
    tidy = lambda rows: sorted(repr([round(v, 6) if isinstance(v, float) else v for v in r]) for r in rows)
    assert tidy(df.select(*cols).collect()) == tidy(got.fetchall())
