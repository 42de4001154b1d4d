"""Goldens of the text rules, derived by hand."""

from pyspark.sql import functions as F

from inkmill.functions import text, topics
from inkmill.operators import cleaning, generation, repair, segmenting


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first().r


def test_clean_for_generation(spark):
    for given, wanted in ((("第一行\n第二行。 下一句"), "第一行第二行。下一句"), ("=== 第 3 页 === 物流\t系统", "物流系统"), (None, ""), ("", "")):
        assert one(spark, given, text.clean_for_generation) == wanted


def test_clean_for_repair(spark):
    for given, wanted in (("什么是《物流》", '什么是"物流？'), ("库存优化。", "库存优化？"), ("为什么重要!", "为什么重要!"), ("技术》", "技术？"), ("答案结束 。", "答案结束 ？"), (None, "")):
        assert one(spark, given, text.clean_for_repair) == wanted


def test_lines(spark):
    kinds = {"1. 技术概述": "title", "第一章 供应链概述": "title", "应用场景：": "title", "1. 概述": "list", "1. 仓库，物流": "list", "• 自动分拣": "list", "(2) 智能调度": "list", "见图1：系统架构，详见后文": "figure", "": "blank", "普通文字。": "text"}
    got = one(spark, "\n".join(kinds), cleaning.line_structure)
    assert [x.kind for x in got] == list(kinds.values())
    assert got[7].line == "图1：系统架构"


def test_redundant_sentences(spark):
    t = "Version 3.5 is out. The quick brown fox!\n\nthe quick brown fox. Short. Short.\n\nTHE QUICK BROWN FOX?"
    df = spark.createDataFrame([(1, t), (2, None), (3, "")], "id int, text string")
    got = {r.id: r for r in cleaning.remove_redundant(df, "id", "text").collect()}
    assert (got[1].text, got[1].redundant) == ("Version 3。5 is out。The quick brown fox。\n\nShort。Short。", 2)
    assert got[2].text is None and got[3].text == ""


def test_formatting(spark):
    assert one(spark, "<标题>1. 概述</标题>\n仓库，物流。运输", text.final_formatting) == "1. 概述 仓库， 物流。 运输"
    assert one(spark, "甲。，乙", text.final_formatting) == "甲。 ，乙"
    assert one(spark, "a < b and c > d", text.final_formatting) == "a d"


def test_terminology(spark):
    t = "仓库管理系统(WMS)很重要。我们用 仓储管理系统 。"
    df = spark.createDataFrame([(1, t), (2, "无")], "id int, text string")
    got = {r.id: r for r in cleaning.standardize_terminology(df, "text").collect()}
    assert got[1].text == "仓库管理系统(WMS)很重要。我们用 WMS 。"
    assert got[1].terms["WMS"] == 2 and got[2].terms == {}


def test_figures_lists_and_concepts(spark):
    tagged = "<图表>图1：甲</图表>\n说明文字\n<列表项>1. 甲</列表项>\n<列表项>2. 乙</列表项>\n尾"
    assert "<图表说明>说明文字</图表说明>" in one(spark, tagged, cleaning.associate_figures)
    assert one(spark, tagged, cleaning.list_regions).count("<列表区域>") == 1
    many = "".join(f"<列表项>{i}. x</列表项>\n" for i in range(20000))
    assert one(spark, many, cleaning.list_regions).count("<列表区域>") == 1
    df = spark.createDataFrame([("前言。物联网是指把物体连接到互联网的一类网络技术。",)], "t string").withColumn("terms", F.create_map(F.lit("IoT"), F.lit(1)))
    assert df.select(cleaning.tag_definitions(F.col("t"), F.col("terms"))).first()[0].startswith('前言。<技术定义 term="IoT">物联网是指')


def test_addresses(spark):
    df = spark.createDataFrame([(1, "见 https://a.example.com/x 及 www.b.example.org 。", "x"), (2, "没有网址的中文。", "y"), (3, None, "z"), (4, "", "w")], "id int, text string, fired string")
    out = text.remove_addresses(df, "text")
    got = {r.id: r for r in out.collect()}
    assert out.columns == ["id", "text", "fired"]
    assert "http" not in got[1].text and "www" not in got[1].text and got[1].fired >= 2
    assert (got[2].text, got[2].fired) == ("没有网址的中文。", 0) and got[3].text is None and got[3].fired is None and got[4].text == ""


def test_clean_documents(spark):
    df = spark.createDataFrame([(1, "1. 技术概述\n仓库管理系统(WMS)是好的。\n图1：架构\n1. 仓库，物流\n2. 运输，配送"), (2, None), (3, "")], "id int, text string")
    got = {r.id: r for r in cleaning.clean_documents(df, "id", "text").collect()}
    assert got[1].titles == ["1. 技术概述"] and got[1].figures == ["图1：架构"] and len(got[1].list_items) == 2
    assert "<" not in got[1].text and got[2].text is None and got[3].text == ""


def test_cleaning_shuffles_no_texts(spark):
    t = "重复的一句话在这里出现。另一句。重复的一句话在这里出现！\n\n短。短。重复的一句话在这里出现"
    out = cleaning.clean_documents(spark.createDataFrame([(1, t), (1, "同号的另一篇文档。")], "id int, text string"), "id", "text")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r.text.strip(), r.redundant) for r in out.orderBy("text").collect()] == [("同号的另一篇文档。", 0), ("重复的一句话在这里出现。 另一句。 短。 短。", 2)]


def test_split_text():
    assert segmenting.split_text("短") == ["短"]
    assert segmenting.split_text("") == []
    long = "。".join("句" * 90 for _ in range(40))
    chunks = segmenting.split_text(long)
    assert all(len(c) <= 800 for c in chunks) and len(chunks) > 4
    assert "".join(segmenting.split_text("x" * 2000, overlap=0)) == "x" * 2000
    assert all(a[-100:] in b[:300] for a, b in zip(chunks, chunks[1:]))


def test_segments(spark):
    df = spark.createDataFrame([(1, "=== 第 1 页 ===\n" + "字" * 900), (2, None), (3, "太短")], "id int, text string")
    got = segmenting.segments(df, "id", "text").collect()
    assert {r.id for r in got} == {1} and all(50 < len(r.content) <= 800 for r in got)


def test_topics(spark):
    cases = {
        None: "供应链技术",
        "声控拣选（VPS）技术：概述": "声控拣选技术",
        "区块链是指一种账本": "区块链",
        "动态补货是一种做法": "动态补货技术",
        "我们使用智能仓储调度系统。": "我们使用智能仓储调度系统",
        "货运与安全": "货运技术",
        "自动驾驶和卡车": "自动驾驶卡车技术",
        "仓库里": "仓库管理技术",
        "什么都没有": "供应链执行技术",
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r.v: r.t for r in df.select("v", topics.extract(F.col("v")).alias("t")).collect()} == cases
    for t, ok in (("物流", False), ("物流技术", True), ("技术定义", False), ("123.5", False), ("的因素", False), ("他的因素", False), (None, False)):
        assert one(spark, t, topics.is_valid) is ok, t


def test_answers(spark):
    assert one(spark, "", generation.quality_answer).startswith("对不起")
    assert one(spark, "短文。", generation.quality_answer) == "短文。"
    long = "".join(f"开头第{i}句话没有关键字眼。" for i in range(100)) + "仓储技术是指一类方法。" + "这里讲应用场景。" + "未完"
    got = one(spark, long, generation.quality_answer)
    assert got.startswith("仓储技术是指一类方法。") and "这里讲应用场景。" in got and "未完" not in got and len(got) // 3 <= 350


def test_questions(spark):
    segs = spark.createDataFrame([(1, "区块链是指一种分布式账本。"), (2, "区块链是指另一种。")], "segment_id int, content string")
    assert generation.expand_questions(segs).count() == 2 * 35
    sampled = generation.sample_questions(segs, ["segment_id"])
    rows = sampled.collect()
    assert all(3 <= sum(r.segment_id == s for r in rows) <= 6 for s in (1, 2)) and {r.topic for r in rows} == {"区块链"}
    assert sorted(r.user for r in rows) == sorted(r.user for r in sampled.collect())


def test_repair(spark):
    assert one(spark, None, repair.fix_question) == "请解释供应链执行技术的概念和应用？"
    assert one(spark, "技术》有什么用处呢？", repair.fix_question) == "什么是技术？它有什么作用？"
    assert one(spark, "短？", repair.fix_question) == "请解释供应链执行技术的重要性？"
    assert one(spark, "仓库管理系统怎么用才好呢", repair.fix_question) == "仓库管理系统怎么用才好呢？"
    assert one(spark, "短", repair.fix_answer).startswith("供应链执行技术是指")
    assert one(spark, "库" * 60 + "。", repair.fix_answer) == "库" * 60 + "？"
    chat = spark.createDataFrame([([("system", "s"), ("user", "短？")],), (None,)], "conversations array<struct<role:string,content:string>>")
    rows = repair.fix_chat(chat).collect()
    assert [t.content for t in rows[0].conversations] == ["s", "请解释供应链执行技术的重要性？"] and rows[1].conversations is None
