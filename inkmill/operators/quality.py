"""QS1, AS1, RL*, MD1, EV*, DD*, IS*, AF1, AG*: scores of question-answer records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions import rules
from inkmill.functions.text import contains_any, found, tokens, words

COUNTERS = (
    "incomplete_question", "invalid_chars", "too_short_answer", "too_long_answer", "no_question_mark", "invalid_topic", "invalid_dimension", "duplicate_qa", "topic_mismatch", "question_answer_mismatch",
)


def with_duplicates(df: DataFrame, order: list[str], question: str = "question", answer: str = "answer") -> DataFrame:
    """DD1-2: dup_question and dup_answer: said before in the order given, the answer by its first 50 characters.

    Only the order and 128 bits of hash of each text are shuffled, without nulls and empty texts.  First occurrences are
    pre-aggregated to one row a text, so that a text that a third of all rows share folds before the shuffle; rows said
    before, the few, are then marked in df.  Rows that share an order are one occurrence.
    """
    ord_ = F.struct(*order)
    flags = None
    for text, flag in ((F.col(question), "dup_question"), (F.substring(answer, 1, 50), "dup_answer")):
        slim = df.where(text != "").select(*order, F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2"))
        first = slim.groupBy("_h1", "_h2").agg(F.min(ord_).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
        again = slim.join(first, ["_h1", "_h2"]).where(ord_ > F.col("_first")).select(*order, *[(F.lit(x == flag)).alias(x) for x in ("dup_question", "dup_answer")])
        flags = again if flags is None else flags.unionByName(again)
    flags = flags.groupBy(*order).agg(F.max("dup_question").alias("dup_question"), F.max("dup_answer").alias("dup_answer"))
    return df.join(flags, order, "left").withColumns({x: F.coalesce(x, F.lit(False)) for x in ("dup_question", "dup_answer")})


def _bad_part(c: Column) -> Column:
    """The first invalid part that the text contains."""
    return F.coalesce(*[F.when(c.contains(p), F.lit(p)) for p in rules.BAD_PARTS])


def question_rules(q: Column, dup: Column) -> list[tuple[Column, int, Column, str | None]]:
    """Condition, points, message and counter of each rule of a non-empty question, in order."""
    n, t, bad = F.length(q), tokens(q), _bad_part(q)
    return [
        (n < 10, 30, F.format_string("问题过短(%d<10)", n), "incomplete_question"),
        (n > 75, 10, F.format_string("问题过长(%d>75.0)", n), None),
        (t < 5, 20, F.format_string("问题token数过少(%d<5)", t), None),
        (t > 37.5, 10, F.format_string("问题token数过多(%d>37.5)", t), None),
        (~(q.endswith("？") | q.endswith("?")), 15, F.lit("问题不以问号结尾"), "no_question_mark"),
        (bad.isNotNull(), 25, F.concat(F.lit("问题包含无效字符 '"), bad, F.lit("'")), "invalid_chars"),
        (dup, 50, F.lit("问题与现有问题重复"), "duplicate_qa"),
    ]


def answer_rules(a: Column, dup: Column) -> list[tuple[Column, int, Column, str | None]]:
    n, t, bad = F.length(a), tokens(a), _bad_part(a)
    return [
        (n < 100, 30, F.format_string("答案过短(%d<100)", n), "too_short_answer"),
        (n > 1200, 15, F.format_string("答案过长(%d>1200.0)", n), "too_long_answer"),
        (t < 50, 20, F.format_string("答案token数过少(%d<50)", t), None),
        (t > 525, 10, F.format_string("答案token数过多(%d>525.0)", t), None),
        (bad.isNotNull(), 25, F.concat(F.lit("答案包含无效字符 '"), bad, F.lit("'")), "invalid_chars"),
        (dup, 20, F.lit("答案与现有答案相似"), "duplicate_qa"),
    ]


def _ratio(terms: Column, low: Column) -> Column:
    """RL2-3: the share of the terms that have more than one character and stand in the text; 0 without terms."""
    return F.coalesce(F.try_divide(F.size(F.filter(terms, lambda w: (F.length(w) > 1) & low.contains(w))), F.size(terms)), F.lit(0.0))


def keywords(q: Column) -> Column:
    """RL1."""
    return F.array_except(words(q), F.array(*[F.lit(s) for s in rules.QUESTION_STOPS]))


def relevance_rules(q: Column, a: Column, topic: Column) -> list[tuple[Column, int, Column, str | None]]:
    topic = F.coalesce(topic, F.lit(""))
    by_topic, by_word = _ratio(F.array_distinct(words(topic)), F.lower(a)), _ratio(keywords(q), F.lower(a))
    return [
        (by_topic < 0.3, 30, F.concat(F.lit("答案中未充分包含主题'"), topic, F.lit("'相关内容")), "topic_mismatch"),
        (by_word < 0.3, 40, F.lit("问题与答案内容不匹配"), "question_answer_mismatch"),
        ((by_word >= 0.3) & (by_word < 0.5), 20, F.lit("问题与答案相关性较低"), None),
        (found(q, "(什么是|定义|解释|概念)") & ~F.substring(a, 1, 100).contains("是"), 15, F.lit("问题询问定义但答案未提供直接解释"), None),
        (q.contains("为什么") & ~contains_any(F.substring(a, 1, 200), rules.CAUSE_WORDS), 15, F.lit("问题询问原因但答案未提供清晰解释"), None),
        (topic.contains("责任归属") & ~topic.contains("自动驾驶") & a.contains("自动驾驶"), 25, F.lit("主题'责任归属'可能应为'自动驾驶技术'的一部分"), "topic_mismatch"),
    ]


def metadata_rules(topic: Column, dimension: Column, difficulty: Column) -> list[tuple[Column, int, Column, str | None]]:
    """MD1; a null value counts as an absent key and costs nothing."""
    return [
        ((topic == "") | F.lower(topic).isin(*rules.TOPIC_BLACKLIST), 20, F.concat(F.lit("无效主题: "), topic), "invalid_topic"),
        (topic.startswith("的") | topic.endswith("的因素") | (topic == "责任归属"), 15, F.concat(F.lit("主题格式可能不正确: "), topic), "invalid_topic"),
        (~dimension.isin(*rules.DIMENSIONS), 10, F.concat(F.lit("无效维度: "), dimension), "invalid_dimension"),
        (~difficulty.isin(*rules.TEMPLATES), 10, F.concat(F.lit("无效难度: "), difficulty), None),
    ]


def _score(checks) -> Column:
    return (F.lit(100) - reduce(lambda x, y: x + y, (F.when(c, F.lit(p)).otherwise(F.lit(0)) for c, p, _, _ in checks))).cast("int")


def _issues(checks) -> Column:
    return F.filter(F.array(*[F.when(c, m) for c, _, m, _ in checks]), lambda x: x.isNotNull())


def evaluate(df: DataFrame, question: str = "question", answer: str = "answer") -> DataFrame:
    """EV1-2, IS1-2 over records with topic, dimension, difficulty, dup_question and dup_answer.

    Adds the four scores, total_score, issues and one INT column n_<counter> a counter.
    """
    q, a, topic = F.col(question), F.col(answer), F.col("topic")
    no_q, no_a = F.coalesce(q, F.lit("")) == "", F.coalesce(a, F.lit("")) == ""
    parts = {
        "question_score": (question_rules(q, F.col("dup_question")), no_q, "问题为空", "incomplete_question"),
        "answer_score": (answer_rules(a, F.col("dup_answer")), no_a, "答案为空", "too_short_answer"),
        "metadata_score": (metadata_rules(topic, F.col("dimension"), F.col("difficulty")), F.lit(False), "", None),
        "relevance_score": (relevance_rules(q, a, topic), no_q | no_a, "问题或答案为空", None),
    }
    scores = {name: F.when(empty, F.lit(0)).otherwise(_score(checks)) for name, (checks, empty, _, _) in parts.items()}
    issues = F.concat(*[F.when(empty, F.array(F.lit(message))).otherwise(_issues(checks)) for checks, empty, message, _ in parts.values()])
    hits: dict[str, list[Column]] = {c: [] for c in COUNTERS}
    for checks, empty, _, when_empty in parts.values():
        if when_empty:
            hits[when_empty].append(empty)
        for c, _, _, counter in checks:
            if counter:
                hits[counter].append(~empty & c)
    counts = {f"n_{name}": reduce(lambda x, y: x + y, (F.coalesce(h.cast("int"), F.lit(0)) for h in hs)) for name, hs in hits.items()}
    out = df.withColumns(scores | {"issues": issues} | counts)
    total = F.col("question_score") * 0.3 + F.col("answer_score") * 0.3 + F.col("metadata_score") * 0.1 + F.col("relevance_score") * 0.3
    return out.withColumn("total_score", F.round(total, 1))


def chat_to_pairs(df: DataFrame, conversations: str = "conversations") -> DataFrame:
    """EV1 for chat records: the last user and assistant turns as question and answer."""
    last = lambda role: F.try_element_at(F.filter(conversations, lambda t: t["role"] == role), F.lit(-1))["content"]
    return df.withColumns({"question": last("user"), "answer": last("assistant")})


def report(evaluated: DataFrame, by: list[str]) -> DataFrame:
    """AF1, AG1-2, IS2: one row a file or other key: total_pairs, average_score, the four buckets, ten counters."""
    s = F.col("total_score")
    return evaluated.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_pairs"),
        F.coalesce(F.round(F.avg(s), 1), F.lit(0.0)).alias("average_score"),
        F.count_if(s >= 90).alias("excellent"),
        F.count_if((s >= 75) & (s < 90)).alias("good"),
        F.count_if((s >= 60) & (s < 75)).alias("fair"),
        F.count_if(s < 60).alias("poor"),
        *[F.sum(f"n_{c}").alias(c) for c in COUNTERS],
    )


def cumulative(reports: DataFrame, order: str) -> DataFrame:
    """counters as running sums over files; a row a file, so the window is small."""
    from pyspark.sql import Window

    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return reports.withColumns({c: F.sum(c).over(w) for c in COUNTERS})
