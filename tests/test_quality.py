import pytest
from pyspark.sql import functions as F

from inkmill.operators import quality, selection

A = "仓库管理系统是" + "用于管理库存与作业的平台。" * 12


def scored(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "ord int, question string, answer string, topic string, dimension string, difficulty string")
    return {r.ord: r for r in quality.evaluate(quality.with_duplicates(df, ["ord"])).collect()}


@pytest.mark.parametrize(
    "question,topic,q,a,r,total",
    [("什么是仓库管理系统？", "仓库管理系统", 80, 100, 60, 82.0), ("仓库管理系统的基本定义和核心要素是什么？", "仓库管理系统", 100, 100, 60, 88.0), ("为什么 WMS 在供应链中很重要？", "WMS", 100, 100, 15, 74.5)],
)
def test_scores(spark, question, topic, q, a, r, total):
    got = scored(spark, [(question, A, topic, "释义类", "basic")])[0]
    assert (got.question_score, got.answer_score, got.relevance_score, got.total_score) == (q, a, r, total)


def test_duplicates_empty_and_nulls(spark):
    q = "仓库管理系统的基本定义和核心要素是什么？"
    got = scored(spark, [(q, A, "仓库管理系统", "释义类", "basic"), (q, A, "仓库管理系统", "释义类", "basic"), ("", A, None, None, None), (None, None, None, "x", "y")])
    assert got[1].total_score == 67.0 and got[1].n_duplicate_qa == 2 and not got[0].dup_question
    assert got[2].question_score == 0 and got[2].issues[0] == "问题为空"
    assert got[3].answer_score == 0 and got[3].metadata_score == 80


def test_report_and_selection(spark):
    rows = [("a", "basic", 90.0), ("a", "basic", 88.0), ("a", "basic", 86.0), ("a", "basic", 85.0), ("b", "expert", 85.0), ("b", "expert", 80.0), ("a", "basic", 80.0), ("b", "expert", 70.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "ord int, dimension string, difficulty string, total_score double")
    got = {r.ord: r.extra for r in selection.balanced(df, ["ord"]).collect()}
    assert got == {0: False, 1: False, 2: False, 3: False, 4: False, 5: True}
    even = df.where("ord in (0, 4, 5)")
    assert selection.balanced(even, ["ord"]).where("extra").count() == 0
    assert [r.ord for r in selection.final_list(df, ["ord"], 2).collect()] == [0, 1]
    assert selection.balanced(df.where("false"), ["ord"]).count() == 0


def test_cumulative(spark):
    df = spark.createDataFrame([(1, "q", None), (2, None, "a")], "file_ord int, question string, answer string")
    df = df.withColumns({"topic": F.lit("t"), "dimension": F.lit("释义类"), "difficulty": F.lit("basic")})
    rep = quality.report(quality.evaluate(quality.with_duplicates(df, ["file_ord"])), ["file_ord"])
    rows = {r.file_ord: r for r in quality.cumulative(rep, "file_ord").collect()}
    assert rows[1].too_short_answer == 1 and rows[2].too_short_answer == 2 and rows[2].incomplete_question == 2
