"""The training-data operators on small cases: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import os
import random

import pytest
from pyspark.sql import functions as F

from inkmill.llm import components, cutoffs, encoding, mixing, neardup, pairs, pieces, sampling, truncation
from inkmill.llm.common import distinct_texts, maybe_among, rank_thresholds, weighted_cuts

VOCAB = os.path.exists(encoding.VOCABULARY)


# 1
def _texts(n, seed=1):
    r = random.Random(seed)
    alphabet = [chr(0x4E00 + i) for i in range(800)]
    return ["".join(r.choices(alphabet, k=r.randint(130, 260))) for _ in range(n)]


def test_near_duplicates_match_brute_force(spark):
    base = _texts(40)
    r = random.Random(2)
    rows = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        for k in range(2):
            u = list(t)
            for _ in range(r.randint(1, 9)):
                u[r.randrange(len(u))] = "改"
            rows.append((1000 + 2 * i + k, "".join(u)))
    rows += [(5000, base[0]), (5001, " 　".join(base[0])), (5002, None), (5003, ""), (5004, "短"), (5000, base[0])]
    df = spark.createDataFrame(rows, "id long, t string").withColumn("h", F.lit("clash"))
    texts = neardup.bare_texts(df, "x", "id", "t", 120)
    got = {(a.id_a, a.id_b) for a in neardup.similar_pairs(texts, 0.6).collect()}
    sets = {i: {"".join(t.split())[k : k + 5] for k in range(len("".join(t.split())) - 4)} for i, t in rows if t and len("".join(t.split())) >= 120}
    ids = sorted(sets)
    want = {(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}
    assert got == want and (0, 5001) in got
    groups = {r.id: r.group_id for r in neardup.similarity_groups(texts, 0.6).collect()}
    assert groups[5000] == groups[5001] == groups[0] == 0 and 5004 not in groups
    root = {i: i for i in ids}
    for _ in ids:
        for x, y in want:
            root[x] = root[y] = min(root[x], root[y])
    assert groups == {i: root[i] for i in ids if any(i in p for p in want)}


def test_near_duplicates_keep_kinds_apart(spark):
    a, b = _texts(2)
    qa = neardup.bare_texts(spark.createDataFrame([(1, a), (2, b)], "id long, t string"), "qa", "id", "t", 120)
    segments = neardup.bare_texts(spark.createDataFrame([(11, a), (12, b + "改"), (13, b)], "id long, t string"), "segment", "id", "t", 120)
    assert [tuple(r) for r in neardup.similar_pairs(qa.union(segments), 0.6).collect()] == [("segment", 12, 13)]
    assert {(r.kind, r.id) for r in neardup.similarity_groups(qa.union(segments), 0.6).collect()} == {("segment", 12), ("segment", 13)}


def test_near_duplicates_of_nothing(spark):
    texts = neardup.bare_texts(spark.createDataFrame([], "id long, t string"), "x", "id", "t", 120)
    assert neardup.similar_pairs(texts, 0.6).count() == 0


def test_posterior_bounds():
    assert neardup.needed_matches(0.6) == sorted(neardup.needed_matches(0.6)) and neardup.needed_matches(0.6)[0] < 0.6 * neardup.STEP


def test_membership_filter(spark):
    df = spark.range(2000).select(F.xxhash64("id").alias("h"), "id")
    keys = df.where("id % 100 = 0").select("h")
    out = maybe_among(df, "h", keys)
    assert out.where("id % 100 = 0").count() == 20 and out.count() < 40


def test_distinct_texts(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, ""), (7, "a")], "id int, t string")
    assert sorted(r.t for r in distinct_texts(df, "t").collect()) == ["", "a", "b"] and distinct_texts(df.where("false"), "t").count() == 0


# 2
def test_allocate():
    assert sampling.allocate([0.5, 0.5], [0, 0], [100, 100], 11) == [6, 5]
    assert sampling.allocate([0.9, 0.1], [0, 3], [100, 100], 10) == [7, 3]
    assert sampling.allocate([0.5, 0.5], [0, 0], [2, 100], 10) == [2, 8]
    assert sampling.allocate([0.5, 0.5], [5, 5], [1, 1], 10) == [1, 1]
    assert sampling.allocate([], [], [], 5) == []
    assert sampling.allocate([1, 1, 1], [0, 0, 0], [9, 9, 9], 10) == [4, 3, 3]


def test_rank_thresholds_are_exact(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("c"), F.shiftrightunsigned(F.xxhash64("id"), 2).alias("_key"), F.col("id").alias("_tie"))
    cuts = spark.createDataFrame([(0, 0, 1000, 1), (1, 0, 1000, 500), (2, 0, 1000, 1000), (2, 1, 1000, 0)], "c long, cut int, n long, k long")
    for r in rank_thresholds(rows, ["c"], cuts).collect():
        mine = sorted((x._key, x._tie) for x in rows.where(F.col("c") == r.c).collect())
        assert (r.at_key, r.at_tie) == (mine[r.k - 1] if r.k else (None, None))


def test_sample(spark):
    rows = [(i, "甲 " if i % 2 else "　甲", "Basic", "x") for i in range(300)] + [(300 + i, "乙", "expert", "y") for i in range(4)] + [(400, None, None, "z")]
    df = spark.createDataFrame(rows, "id long, dimension string, difficulty string, extra string")
    targets = spark.createDataFrame([("甲", "basic", 0.5, 0), ("乙", "expert", 0.5, 2), ("丙", "basic", 0.0, 1)], "dimension string, difficulty string, target_share double, min_rows int")
    plan = sampling.plan_sample(df, targets, 0.1)
    by = {r.dimension: r for r in plan.collect()}
    assert (by["甲"].quota, by["乙"].quota, by["丙"].quota) == (26, 4, 0)
    assert {r.dimension for r in sampling.shortfalls(plan).collect()} == {"乙", "丙"}
    got = sampling.proportional_sample(df, plan, "id")
    assert got.count() == 30 and got.columns == df.columns
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in sampling.proportional_sample(df, plan, "id").collect())
    assert sampling.plan_sample(df.where("false"), targets, 0.1).agg(F.sum("quota")).first()[0] == 0


# 3
@pytest.mark.parametrize("seed", range(6))
def test_pieces(seed):
    r = random.Random(seed)
    text = "".join(r.choice(["字", "a", "9", "。", "，", "\n", "\n\n", " ", "x" * r.randint(1, 400)]) for _ in range(r.randint(50, 900)))
    out = pieces.bisect(text, 800, 150)
    assert "".join(text[a:b] for _, _, a, b, _, _ in out) == text
    assert all(len(p[4]) <= 800 and p[4] == text[p[1] : p[3]] for p in out)
    assert all(p[1] >= q[1] and p[1] <= p[2] for q, p in zip(out, out[1:]))


def test_pieces_forced_and_empty(spark):
    assert pieces.bisect("", 800, 150) == [] and pieces.bisect("x" * 800, 800, 150)[0][4] == "x" * 800
    assert any(p[5] for p in pieces.bisect("x" * 801, 800, 150))
    assert not any(p[5] for p in pieces.bisect("。" + "x" * 800, 800, 150))
    assert all(len(p[4]) <= 800 for p in pieces.bisect("字" * 100_000, 800, 150))
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "句。" * 500, 0), (3, "句。" * 500, 1), (None, "句。" * 500, 0)], "id int, t string, start int")
    got = pieces.oversized_pieces(df, "id", "t", 800, 150)
    assert {r.id for r in got.collect()} == {3, None} and got.where("id = 3 and piece_no = 0").count() == 1


# 4
def test_cutoffs(spark):
    r = random.Random(4)
    rows = [(i, r.choice("ab") + " ", float(r.randint(0, 60)), ["i"]) for i in range(3000)] + [(9000, "a", None, None), (9001, "a", float("nan"), None), (9002, None, 5.0, None), (9003, "c", 1.0, None)]
    rows += rows[:100]
    df = spark.createDataFrame(rows, "id long, g string, s double, issues array<string>")
    targets = spark.createDataFrame([("a", 30), ("b", 90), ("c", 100), ("d", 50)], "g string, keep_percent int")
    scored = cutoffs.scored_records(df, "id", "g", "s", targets)
    cuts = {x.grp: x for x in cutoffs.cutoffs(scored, targets.withColumnRenamed("g", "grp")).collect()}
    for g, pct in (("a", 30), ("b", 90), ("c", 100)):
        s = sorted((x[2] for x in set(map(lambda y: (y[0], y[1], y[2]), rows)) if x[1] is not None and x[1].strip() == g and x[2] is not None and x[2] == x[2]), reverse=True)
        want = s[-(-len(s) * pct // 100) - 1]
        assert (cuts[g].cutoff, cuts[g].kept) == (want, sum(x >= want for x in s)), g
    assert cuts["d"].cutoff is None and cuts["d"].kept == 0
    assert cutoffs.kept(scored.where("false"), cutoffs.cutoffs(scored.where("false"), targets.withColumnRenamed("g", "grp"))).count() == 0


# 5
def test_components(spark):
    links = [(1, 2), (2, 3), (3, 3), (7, 8), (8, 7), (None, 4), (10, None), *((100 + i, 101 + i) for i in range(60))]
    df = spark.createDataFrame(links, "a int, b int")
    got = {r.node: r.root for r in components.components(df, "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, **{100 + i: 100 for i in range(61)}}
    assert components.components(df.where("false"), "a", "b").count() == 0
    comps = components.components(df, "a", "b")
    recs = spark.createDataFrame([(1,), (1,), (3,), (7,), (None,), (55,)], "e int")
    assert sorted(map(tuple, components.tied_groups(recs, "e", comps).collect())) == [(1, 1), (3, 1)]


def test_splits(spark):
    r = random.Random(5)
    rows = [(i, None if r.random() < 0.1 else (1 if r.random() < 0.3 else r.randint(2, 300)), r.choice("xyz")) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, e int, lab string")
    links = spark.createDataFrame([(2, 3), (3, 4), (900, 5), (6, 900)], "a int, b int")
    targets = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split_name string, target_share double")
    out = components.entity_splits(df, "id", "e", "lab", links, "a", "b", targets)
    got = out.collect()
    assert len(got) == 3000
    place = {}
    for x in got:
        if x.group_id is not None:
            assert place.setdefault(x.group_id, x.split_name) == x.split_name
    assert place[2] == next(x.split_name for x in got if x.entity == 4)
    share = {s: sum(x.split_name == s for x in got) / 3000 for s in ("train", "validation", "test")}
    assert abs(share["train"] - 0.8) < 0.01 and abs(share["test"] - 0.1) < 0.01
    assert components.entity_splits(df.where("false"), "id", "e", "lab", links, "a", "b", targets).count() == 0


def test_flow_plan():
    # one component of each bundle is whole; shares within the smallest component
    r = random.Random(6)
    bundles = [(float(s), lab, r.randint(1, 40)) for s in (1, 2, 3, 7, 20, 55) for lab in "xyz"] + [(900.0, "x", 1), (700.0, "y", 2)]
    shares = [0.8, 0.1, 0.1]
    plan = components.flow_plan(bundles, shares)
    assert [sum(p) for p in plan] == [c for _, _, c in bundles]
    total = sum(s * c for s, _, c in bundles)
    for j, x in enumerate(shares):
        assert abs(sum(s * p[j] for (s, _, _), p in zip(bundles, plan)) - total * x) <= 3
        for lab in "xyz":
            n = sum(s * c for s, y, c in bundles if y == lab)
            large = max(s for s, y, _ in bundles if y == lab)
            assert abs(sum(s * p[j] for (s, y, _), p in zip(bundles, plan) if y == lab) - n * x) <= max(3, large)
    # a component beyond the quotas of all splits but one, no shares, no bundles
    assert components.flow_plan([(90.0, "x", 1), (1.0, "x", 10)], [0.5, 0.5])[0] in ([1, 0], [0, 1]) and components.flow_plan([(90.0, "x", 1), (1.0, "x", 10)], [0.5, 0.5])[1] in ([0, 10], [10, 0])
    assert components.flow_plan([(1.0, "x", 3)], [0.0]) == [[0]] and components.flow_plan([], [1.0]) == []


def test_splits_of_skewed_components_and_many_labels(spark):
    # one entity holds a third of the rows, sizes beyond SIZES are classed, and there are more labels than count for themselves
    rows = [(i, 1, "hot") for i in range(2000)] + [(10_000 + i, 2 + i % 3, f"lab{i % 100}") for i in range(2000)] + [(20_000 + i, 100 + i, f"lab{i % 100}") for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, e int, lab string")
    targets = spark.createDataFrame([("train", 0.6), ("validation", 0.25), ("test", 0.15), ("none", None)], "split_name string, target_share double")
    got = components.entity_splits(df, "id", "e", "lab", spark.createDataFrame([], "a int, b int"), "a", "b", targets).collect()
    share = {s: sum(x.split_name == s for x in got) / 6000 for s in ("train", "validation", "test")}
    assert len(got) == 6000 and abs(share["train"] - 0.6) < 0.01 and abs(share["validation"] - 0.25) < 0.01
    assert len({(x.entity, x.split_name) for x in got}) == len({x.entity for x in got})


# 6
def test_defects(spark):
    zh = "仓库里的月台调度需要和承运合同一并设计，让新品更快上架。"
    en = "The dock team moves the pallets to the buffer lane before the trucks arrive at the gate."
    docs = spark.createDataFrame([(i, t * 4, lang) for i, (t, lang) in enumerate([(zh, "zh"), (en, "en"), (zh, "zh-CN"), (en, "EN"), (en, None)] * 30)], "doc_id long, text string, lang string")
    model = pairs.fit_languages(docs)
    listing = "要点如下：\n1. 推送舱单，使返工量减半\n2. 引导读写器，避免整车返程\n3. 改写库位，使返工量减半"
    rows = [
        ("什么是月台调度？", None, "empty"), ("什么是月台调度？", "​ \n", "empty"), ("什么是月台调度？", "答：待补充", "empty"), ("什么是月台调度？", "<p></p>", "empty"),
        ("什么是月台调度？", "答：什么是月台调度?", "copy"), ("什么是月台调度？", "您想知道的是什么是月台调度？", "copy"), ("月台调度能离线吗？", "月台调度能离线吗？不能。", None),
        ("什么是月台调度？", "关于月台调度，很抱歉，我无法回答这个问题。", "refusal"), ("什么是月台调度？", "客服模板里的“对不起，我不能回答”应当附上编号。" + zh, None),
        ("什么是月台调度？", en, "language"), ("什么是月台调度？", "月台调度: " + en, "language"), ("什么是月台调度？", zh + "（Dock Scheduling System）也叫这个名字。", None), (None, en, None),
        ("什么是月台调度？", zh + "让新品更快…", "truncated"), ("什么是月台调度？", zh + "所谓读写器，", "truncated"), ("什么是月台调度？", listing + "\n4. ", "truncated"), ("什么是月台调度？", listing + "\n4. 改写库", "truncated"),
        ("什么是月台调度？", listing, None), ("要停工吗？", "需要。", None), ("什么是月台调度？", zh * 2000, None),
    ]
    rows = [(i, q, a, w) for i, (q, a, w) in enumerate(rows)] + [(100 + i, "什么是月台调度？", listing, None) for i in range(20)]
    df = spark.createDataFrame(rows, "qa_id long, user string, assistant string, want string")
    got = {r.qa_id: r.defect for r in pairs.defects(df, "qa_id", "user", "assistant", model).collect()}
    assert {i: got.get(i) for i, *_ in rows} == {i: w for i, _, _, w in rows}
    assert pairs.defects(df.where("false"), "qa_id", "user", "assistant", model).count() == 0


def _no_docs(spark):
    return pairs.fit_languages(spark.createDataFrame([], "doc_id long, text string, lang string"))


def _defects(spark, answers):
    df = spark.createDataFrame([(i, "什么是月台调度？", a) for i, a in enumerate(answers)], "qa_id long, user string, assistant string")
    return {r.qa_id: r.defect for r in pairs.defects(df, "qa_id", "user", "assistant", _no_docs(spark)).collect()}


def test_recurring_cuts_are_no_usual_ends(spark):
    # the endings stand nowhere else and close several differing answers, as in the tables
    cuts = [f"第{i}批托盘由货位{chr(0x4E00 + i)}收走，便于追责。{x}" for i, x in enumerate(["其中最关键的是"] * 5 + ["还要看夜班闸"] * 5)]
    assert _defects(spark, cuts) == {i: "truncated" for i in range(10)}
    items = [f"要点如下：\n1. 推送{chr(0x4E00 + i)}，使返工量减半\n2. 引导读写器，使返工量减半" for i in range(4)]
    marked = ["月台调度让新品更快上架。✅", "月台调度让新品更快上架！（参见表25）", "月台调度让新品更快上架。（参见表2）👍"]
    assert _defects(spark, items + marked) == {}
    assert set(_defects(spark, ["月台调度让新品更快上架。（见登车桥", "月台调度让新品更快✅"]).values()) == {"truncated"}


def test_list_ends_seen_once_are_whole(spark):
    # the verdict doesn't depend on the size of the table
    answers = ["要点如下：\n1. 推送舱单，使返工量减半\n2. 引导读写器，避免整车返程", "要点如下：\n1. 引导托盘，避免整车返程\n2. 改写库位，使返工量减半"]
    assert _defects(spark, answers) == {}


def test_short_answers_and_statements_about_things_are_whole(spark):
    zh = "仓库里的月台调度需要和承运合同一并设计，让新品更快上架。"
    answers = ["是。", "对。", "5%", "可以", "不需要", "RFID", "AI。", "该模块不能判断包装破损。", "这类标签不了解温度变化，需另配传感器。", "由于缺少历史数据，该模型目前无法给出预测。", "扫描枪无法读取月台时，由班组长人工登记。", zh + "我无法回答这个问题的情形很少。", "我不清楚具体数字，但月台调度一般分三步完成。", "可以，夜班需要人工复核。"]
    assert _defects(spark, answers) == {}
    long = "您好，感谢您一直以来的信任与支持，" + "我们非常重视每一个问题，" * 20 + "但是这个问题超出了我的知识范围。"
    refusals = ["不清楚。", "As an assistant I am unable to comment on this topic.", "很抱歉。此类信息不在我的职责之内。", "关于月台，目前该话题不便讨论，以免造成误导。", long, "I'm sorry, but I can't help with that request.", "Das tut mir leid, ich kann diese Frage leider nicht beantworten."]
    assert _defects(spark, refusals) == dict.fromkeys(range(len(refusals)), "refusal")


def test_copies_of_short_questions_and_refusing_verbs():
    assert pairs.is_copy("AI？", "AI。") and pairs.is_copy("什么？", "答：什么？") and pairs.is_copy("Why?", "You asked: Why?") and pairs.is_copy("什么是月台？", "您提问的内容如下：什么是月台？")
    assert not pairs.is_copy("？", "？") and not pairs.is_copy(None, "月台") and not pairs.is_copy("AI？", "AI是人工智能。")
    assert not pairs.is_refusal("系统能提供离线模式吗？", "不能提供。") and pairs.is_refusal("什么是月台？", "无法回答。")


def test_languages_without_documents_and_short_texts():
    from inkmill.llm.languages import Languages

    zh, en = "仓库里的月台调度需要和承运合同一并设计，让新品更快上架。" * 5, "The dock team moves the pallets to the buffer lane before the trucks arrive at the gate. " * 5
    m = Languages.fit([zh, en] * 10, ["zh", "en"] * 10)
    questions = ["什么是月台调度？", "什么是月台调度？", "什么是月台调度？", "What is the dock team?", "What is the dock team?", "什么是月台调度？", "", "什么是月台调度？", "월차는 무엇입니까?"]
    answers = ["야간조는 운반차 다섯 대를 대조하고 회수 용기를 나눕니다.", "WMS、TMS。", "Dock Scheduling System", "需要月台。", "The gate.", "", "The gate team moves.", "При нехватке места", "仓库里的月台调度"]
    assert m.differ(questions, answers).tolist() == [True, False, False, True, False, False, False, True, True]
    assert m.differ(questions * 400, [answers[0] * 50] * 400 * len(questions)).tolist()[:9] == [True, True, True, True, True, True, False, True, False]
    assert Languages.fit([], []).differ(["什么"], ["what"]).tolist() == [False]


def test_copies_count_once_as_evidence(spark):
    # the line of a list breaks off after 夜班闸 and goes on elsewhere; only copies of one text have that ending before another line
    copies = ["要点如下：\n1. 推送夜班闸\n2. 引导读写器，"] * 5 + ["要点如下：\n1. 推送夜班闸口的舱单，使返工量减半。", "要点如下：\n1. 改写夜班闸口的库位，使返工量减半。", "要点如下：\n1. 引导夜班闸口的托盘，使返工量减半。"]
    assert _defects(spark, [*copies, "要点如下：\n1. 引导读写器\n2. 推送夜班闸"]).get(8) == "truncated"


# 7
@pytest.mark.skipif(not VOCAB, reason="needs the public vocabulary")
def test_encoding_is_that_of_the_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(encoding.VOCABULARY)
    lib.encode_special_tokens = True
    r = random.Random(7)
    marks = ["仓库", "aaaa", "aaa", " the", "  ", "\n\n", "don't", "<|endoftext|>", "123", "🚚", "é", "ß", "のの", "​", "。", "!!!", "\t", "한국", "Привет", "a", "b"]
    texts = [None, "", " ", "\n", "<|endoftext|>", "a" * 5001, "字" * 20000, *("".join(r.choices(marks, k=r.randint(1, 300))) for _ in range(200))]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, ids int").repartition(3)
    got = {x.doc_id: x.ids for x in encoding.encode_texts(df, "doc_id", "text").collect()}
    assert got == {i: lib.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    counts = {x.doc_id: x.tokens for x in encoding.count_tokens(df, "doc_id", "text").collect()}
    assert counts == {i: len(v) for i, v in got.items()}
    assert encoding.encode_texts(df.where("false"), "doc_id", "text").count() == 0


# 8
def test_route():
    # source 0 shares its only texts with source 1, which has more of its own
    got = mixing.route([((0, 1), 100.0), ((1,), 100.0)], [100.0, 100.0], [1, 1])
    assert sum(v for (_, s, _), v in got.items() if s == 0) == pytest.approx(100) and sum(v for (_, s, _), v in got.items() if s == 1) == pytest.approx(100)
    got = mixing.route([((0,), 10.0)], [25.0], [2])
    assert got == {(0, 0, 0): pytest.approx(10), (0, 0, 1): pytest.approx(10)}
    assert mixing.route([], [5.0], [3]) == {}


@pytest.mark.skipif(not VOCAB, reason="needs the public vocabulary")
def test_mixture(spark):
    rows = [(i, f"文本 number {i} " * 5, "big") for i in range(3000)] + [(5000 + i, f"small {i} " * 5, "tiny") for i in range(40)] + [(9000, None, "big"), (9001, "", None), (9002, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("tiny", 0.5, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    sized = mixing.sized_documents(docs)
    mixed = mixing.mix(sized, targets, 0.4)
    rep = {r.source: r for r in mixing.mix_report(sized, targets, 0.4, mixed).collect()}
    assert rep["tiny"].short and rep["none"].short and not rep["big"].short
    assert abs(rep["big"].mixed_tokens / rep["big"].wanted - 1) < 0.1 and rep["tiny"].mixed_tokens == 3 * rep["tiny"].tokens
    longest = sized.agg(F.max("tokens")).first()[0]
    assert abs(rep["big"].mixed_tokens - rep["big"].wanted) <= longest
    assert mixed.agg(F.max("uses")).first()[0] == 3 and mixed.groupBy("doc_id").count().where("count > 1").count() == 0
    assert mixing.mix(sized.where("false"), targets, 0.4).count() == 0


def test_mixture_meets_quotas_within_a_document(spark):
    r = random.Random(8)
    rows = [(i, r.choice("abc"), r.randint(1, 900), i) for i in range(4000)] + [(5000 + i, r.choice("abc"), 300, i % 40) for i in range(600)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, tokens long, h long")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.2, 3)], "source string, target_share double, max_repeats int")
    rep = mixing.mix_report(sized, targets, 0.9, mixing.mix(sized, targets, 0.9)).collect()
    assert all(x.short or abs(x.mixed_tokens - x.wanted) <= 900 for x in rep) and not all(x.short for x in rep)


def test_weighted_cuts_match_brute_force(spark):
    rows = spark.range(3000).select((F.col("id") % 2).alias("c"), F.shiftrightunsigned(F.xxhash64("id"), 2).alias("_key"), F.col("id").alias("_tie"), (F.col("id") % 7).alias("w"))
    cuts = spark.createDataFrame([(0, 0, 10.0), (0, 1, 2222.4), (1, 2, 4000.0)], "c long, cut int, at double")
    for x in weighted_cuts(rows, ["c"], cuts, "w").collect():
        cell, at = {0: (0, 10.0), 1: (0, 2222.4), 2: (1, 4000.0)}[x.cut]
        total, reach = 0, [0]
        for y in sorted((y._key, y.w) for y in rows.where(F.col("c") == cell).collect()):
            total += y[1]
            reach.append(total)
        assert abs(x.reached - at) == min(abs(t - at) for t in reach)
        assert rows.where((F.col("c") == cell) & (F.col("_key") <= x.at_key)).agg(F.sum("w")).first()[0] == x.reached


def test_mixture_draws_on_copies(spark):
    # all of "hot" are copies of one text, which "rare" has too, but may use only once
    rows = [(i, "hot", 10, 7) for i in range(2000)] + [(5000 + i, "big", 10, 100 + i) for i in range(3000)] + [(9000, "rare", 10, 7)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, tokens long, h long")
    targets = spark.createDataFrame([("hot", 0.5, 2), ("big", 0.49, 1), ("rare", 0.01, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(sized, targets, 0.8)
    rep = {r.source: r for r in mixing.mix_report(sized, targets, 0.8, mixed).collect()}
    assert not rep["hot"].short and abs(rep["hot"].mixed_tokens / rep["hot"].wanted - 1) < 0.1 and abs(rep["big"].mixed_tokens / rep["big"].wanted - 1) < 0.1
    uses = {r.doc_id: r.uses for r in mixed.groupBy("doc_id").agg(F.sum("uses").alias("uses")).collect()}
    assert max(uses.values()) <= 2 and max(n for i, n in uses.items() if i >= 5000) == 1 and uses.get(9000, 0) <= 1


# 9
def test_truncation(spark):
    r = random.Random(9)
    nouns = ["月台", "舱单", "读写器", "货位", "托盘", "网关"]
    sentence = lambda: f"在夜间低谷期，{r.choice(nouns)}会合并{r.choice(nouns)}{r.randint(10, 99)}批，让新品更快上架。"
    body = lambda k=6: "".join(sentence() for _ in range(k))
    cut = [body() + "在夜间低谷期，托盘会合", body() + "在夜间低谷期，托盘会合并…", body() + "在夜间低谷期，托盘会<", "标题\n" + body() + "\n在夜间低谷期，网关", body() + "在夜间低谷期，托盘会合&nb"]
    whole = [
        body(), body() + "\n编号：AB-123", body() + "\n2024年6月2日", body() + "\n（完）", body() + "\n=== 第 3 页 ===", body() + "\n—— 白荻站运营组", body() + "\n| 1 | 2 |", body() + "\nhttp://a.example/1", body() + "\n附表4 货位",
        None, "", " \n", "托盘", "0", "第一行没有句号\n第二行也没有句号\n第三行在夜间低谷期，托盘会合", body(3000),
    ]
    rows = [(i, t) for i, t in enumerate([*cut, cut[0], *whole, *(body() for _ in range(50))])]
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, tri string")
    assert {x.doc_id for x in truncation.truncated(df).collect()} == set(range(len(cut) + 1))
    assert truncation.truncated(df.where("false")).count() == 0
    rep = truncation.truncation_report(df.withColumn("source", F.lit(None).cast("string")), truncation.truncated(df)).first()
    assert rep.truncated == len(cut) + 1


def test_list_items_do_not_acquit_prose_lines(spark):
    body = lambda i: "".join(f"在夜间低谷期，{chr(0x4E00 + i)}会合并静态质检批次{k}批，让新品更快上架。" for k in range(10, 16))
    lists = [f"{body(i)}\n- 静态质检批次\n附表{i} 静态质检批次\n{body(i + 20)}" for i in range(6)]
    docs = [*lists, body(50) + "\n汀州湾校验了静态质检批次", body(51) + "\n- 托盘与静态质检批次"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    assert [x.doc_id for x in truncation.truncated(df).collect()] == [6]


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"p{n}_found" for n in (1, 2, 3, 4, 5, 6, 8, 9)} | {"p7_ids"} <= names and set(entry.oracle_sql()) <= names
