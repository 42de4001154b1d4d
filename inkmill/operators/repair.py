"""FQ*, FA*, FX*, FV1: repair of flat and chat question-answer records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions import rules
from inkmill.functions.text import clean_for_repair, found, strip, sub


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), 0)


def fix_question(q: Column) -> Column:
    """FQ1-4."""

    def repaired(c: Column) -> Column:
        cut = reduce(lambda a, b: a | b, (found(c, p) for p in rules.CUT_QUESTIONS))
        key = F.regexp_extract(c, r"(?Ud)([\w\s]{2,})", 1)
        rebuilt = F.when(key == "", F.lit(rules.QUESTION_UNKNOWN)).otherwise(F.concat(F.lit("什么是"), strip(key), F.lit("？它有什么作用？")))
        return (
            F.when(cut, rebuilt)
            .when(c.contains("哪些公司最") & (F.length(c) < 15), F.lit(rules.QUESTION_COMPANIES))
            .when(F.length(c) < 10, F.lit(rules.QUESTION_SHORT))
            .when(c.endswith("？") | c.endswith("?"), c)
            .otherwise(F.concat(c, F.lit("？")))
        )

    return F.when(F.coalesce(q, F.lit("")) == "", F.lit(rules.QUESTION_EMPTY)).otherwise(_let(clean_for_repair(q), repaired))


def fix_answer(a: Column) -> Column:
    """FA1-2."""

    def repaired(c: Column) -> Column:
        c = sub(c, rules.PAGE_MARK)
        c = F.when(found(c, r"[,，:：;；]\s*$"), F.concat(F.substring(c, F.lit(1), F.length(c) - 1), F.lit("。"))).otherwise(c)
        return F.when(c.endswith("包括") | c.endswith("例如") | c.endswith("有"), F.concat(c, F.lit(rules.ANSWER_TAIL))).otherwise(c)

    return F.when(F.length(F.coalesce(a, F.lit(""))) < 50, F.lit(rules.ANSWER_SHORT)).otherwise(_let(clean_for_repair(a), repaired))


def fix_pairs(df: DataFrame, question: str = "user", answer: str = "assistant") -> DataFrame:
    """FX1, FX3: repaired texts and ``fixed``, whether either changed."""
    q, a = fix_question(F.col(question)), fix_answer(F.col(answer))
    changed = ~(q.eqNullSafe(F.col(question)) & a.eqNullSafe(F.col(answer)))
    return df.withColumns({"fixed": changed, question: q, answer: a})


def fix_chat(df: DataFrame, conversations: str = "conversations") -> DataFrame:
    """FX2: turns of user and assistant repaired in place; null conversations stay null."""
    turn = lambda t: F.struct(t["role"].alias("role"), F.when(t["role"] == "user", fix_question(t["content"])).when(t["role"] == "assistant", fix_answer(t["content"])).otherwise(t["content"]).alias("content"))
    return df.withColumn(conversations, F.transform(conversations, turn))


def first_turn(conversations: Column, role: str) -> Column:
    return F.get(F.filter(conversations, lambda t: t["role"] == role), 0)["content"]


def validation(df: DataFrame, question: Column, answer: Column) -> DataFrame:
    """FV1: one row: total, good questions and answers, their percentages."""
    good_q = F.coalesce((F.length(question) >= 10) & (question.endswith("？") | question.endswith("?")), F.lit(False))
    good_a = F.coalesce(F.length(answer) >= 50, F.lit(False))
    counted = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(good_q).alias("good_questions"), F.count_if(good_a).alias("good_answers"))
    return counted.withColumns({f"{k}_percent": F.try_divide(F.col(k) * 100.0, F.col("total")) for k in ("good_questions", "good_answers")})
