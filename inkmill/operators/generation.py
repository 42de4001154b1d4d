"""AN*, QG*, VL*, ST1: answers and questions from segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions import rules, topics
from inkmill.functions.text import clean_for_generation, contains_any, let, sentences

BUDGET = 350


def _picked(acc: Column, s: Column) -> Column:
    """acc with s appended and its joined length carried along, so that no step recounts."""
    n = acc["chars"] + F.length(s) + F.when(F.size(acc["sel"]) > 0, 1).otherwise(0)
    return F.struct(F.array_append(acc["sel"], s).alias("sel"), n.alias("chars"), acc["stop"].alias("stop"))


def _stopped(acc: Column, stop: Column) -> Column:
    return F.struct(acc["sel"].alias("sel"), acc["chars"].alias("chars"), stop.alias("stop"))


def _toks(chars: Column) -> Column:
    return F.floor(chars / 3)


def quality_answer(text: Column, budget: int = BUDGET, cleaned: Column | None = None) -> Column:
    """AN1-6: the cleaned text if it fits; else a definition sentence, sentences with key words up to 0.7 of the budget,
    then sentences in order until one does not fit; less than 50 characters fall back to the first three sentences."""

    def build(s: Column) -> Column:
        first = F.get(F.filter(s, lambda x: contains_any(x, rules.ANSWER_DEFINITIONS)), 0)
        start = F.when(first.isNotNull(), F.struct(F.array(first).alias("sel"), F.length(first).alias("chars"), F.lit(False).alias("stop"))).otherwise(
            F.struct(F.array().cast("array<string>").alias("sel"), F.lit(0).alias("chars"), F.lit(False).alias("stop"))
        )
        keyed = F.flatten(F.transform(F.array(*[F.lit(k) for k in rules.ANSWER_KEYS]), lambda k: F.transform(s, lambda x: F.struct(k.alias("k"), x.alias("s")))))

        def key(acc: Column, v: Column) -> Column:
            take = v["s"].contains(v["k"]) & ~F.array_contains(acc["sel"], v["s"])
            moved = F.when(take, _picked(acc, v["s"])).otherwise(acc)
            return F.when(acc["stop"], acc).otherwise(F.get(F.transform(F.array(moved), lambda m: _stopped(m, _toks(m["chars"]) > 0.7 * budget)), 0))

        def fill(acc: Column, x: Column) -> Column:
            longer = acc["chars"] + F.length(x) + F.when(F.size(acc["sel"]) > 0, 1).otherwise(0)
            return F.when(acc["stop"] | F.array_contains(acc["sel"], x), acc).when(_toks(longer) <= budget, _picked(acc, x)).otherwise(_stopped(acc, F.lit(True)))

        done = F.aggregate(s, F.get(F.transform(F.array(F.aggregate(keyed, start, key)), lambda a: _stopped(a, F.lit(False))), 0), fill)
        answer = F.array_join(done["sel"], " ")
        return F.get(F.transform(F.array(answer), lambda a: F.when(F.length(a) < 50, F.array_join(F.slice(s, 1, 3), " ")).otherwise(a)), 0)

    def whole(c: Column) -> Column:
        return F.when(_toks(F.length(c)) <= budget, c).otherwise(clean_for_generation(F.get(F.transform(F.array(sentences(c)), build), 0)))

    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(rules.APOLOGY)).otherwise(let(clean_for_generation(text), whole) if cleaned is None else whole(cleaned))


def templates(spark: SparkSession) -> DataFrame:
    """dimension, dim_no, difficulty, tmpl_no, template: 35 rows."""
    rows = [(d, i, f, k, t) for i, (d, fs) in enumerate(rules.DIMENSIONS.items()) for f in fs for k, t in enumerate(rules.TEMPLATES[f])]
    return spark.createDataFrame(rows, "dimension string, dim_no int, difficulty string, tmpl_no int, template string")


def with_topic_and_answer(segs: DataFrame, content: str) -> DataFrame:
    """Topic and answer, once a segment; what several expressions name is a column of its own, which plans faster than nested lambdas."""
    c = F.col(content)
    out = segs.withColumn("_cleaned", clean_for_generation(c))
    out = out.withColumns({"topic": topics.extract(c, F.col("_cleaned")), "assistant": quality_answer(c, cleaned=F.col("_cleaned"))}).drop("_cleaned")
    for step in (topics.strong, topics.supported):
        out = out.withColumn("topic", step(F.col("topic"), c))
    return out


def expand_questions(segs: DataFrame, content: str = "content") -> DataFrame:
    """QG1, 3, 4: every question of every segment (topic and answer as with_topic_and_answer): the full product with the
    35 templates, which are broadcast."""
    joined = with_topic_and_answer(segs, content).crossJoin(F.broadcast(templates(segs.sparkSession)))
    q = F.replace(F.col("template"), F.lit("{topic}"), F.col("topic"))
    return joined.withColumn("user", F.when(q.endswith("？"), q).otherwise(F.concat(q, F.lit("？")))).withColumn("system", F.lit(rules.SYSTEM_PROMPT))


def _draw(seed: int, *cols: str | Column) -> Column:
    """A pseudo-random text, the same on every engine: a digest of the seed and the columns."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]))


def drawn_templates(id_cols: list[str], seed: int = 11, dims: int = 3) -> Column:
    """QG2, 5, 6: array of (template, dim_no, difficulty, tmpl_no, dimension) drawn for a segment: three dimensions, of
    each one or two templates, by a digest in place of random numbers; one drawn in two dimensions stays in the first."""
    order = {d: i for i, d in enumerate(rules.DIMENSIONS)}
    of = F.array(*[F.array(*[F.struct(F.lit(f).alias("difficulty"), F.lit(k).alias("tmpl_no"), F.lit(t).alias("template")) for f in fs for k, t in enumerate(rules.TEMPLATES[f])]) for fs in rules.DIMENSIONS.values()])
    h = lambda *c: _draw(seed, *id_cols, *c)
    by_draw = F.sort_array(F.array(*[F.struct(h(F.lit(d)).alias("h"), F.lit(d).alias("dimension"), F.lit(i).alias("dim_no")) for d, i in order.items()]))

    def of_dimension(d: Column) -> Column:
        ranked = F.sort_array(F.transform(F.get(of, d["dim_no"]), lambda t: F.struct(h(d["dimension"], t["template"]).alias("h"), t["difficulty"].alias("difficulty"), t["tmpl_no"].alias("tmpl_no"), t["template"].alias("template"))))
        n = F.when(F.substring(h(d["dim_no"]), 1, 1) < "8", 1).otherwise(2)
        return F.transform(F.slice(ranked, 1, n), lambda t: F.struct(t["template"].alias("template"), d["dim_no"].alias("dim_no"), t["difficulty"].alias("difficulty"), t["tmpl_no"].alias("tmpl_no"), d["dimension"].alias("dimension")))

    drawn = F.sort_array(F.flatten(F.transform(F.slice(by_draw, 1, dims), of_dimension)))
    return let(drawn, lambda q: F.filter(q, lambda x, i: (i == 0) | (F.get(q, i - 1)["template"] != x["template"])))


def ask(segs: DataFrame, drawn: str = "_drawn") -> DataFrame:
    """A row a drawn template, which the topic completes to the question."""
    out = segs.select("*", F.inline(drawn)).drop(drawn)
    q = F.replace(F.col("template"), F.lit("{topic}"), F.col("topic"))
    return out.withColumn("user", F.when(q.endswith("？"), q).otherwise(F.concat(q, F.lit("？")))).withColumn("system", F.lit(rules.SYSTEM_PROMPT))


def with_drawn(segs: DataFrame, id_cols: list[str], content: str = "content", seed: int = 11, dims: int = 3) -> DataFrame:
    """Topic, answer and ``_drawn``, the drawn templates, of each segment; segments without an id have none.  Row-local."""
    there = segs.dropna(subset=id_cols)
    return with_topic_and_answer(there, content).withColumn("_drawn", drawn_templates(id_cols, seed, dims))


def sample_questions(segs: DataFrame, id_cols: list[str], content: str = "content", seed: int = 11, dims: int = 3) -> DataFrame:
    """QG2, 5, 6: the drawn questions of each segment."""
    return ask(with_drawn(segs, id_cols, content, seed, dims))


def main_topics(qa: DataFrame, segment: str) -> DataFrame:
    """(segment, topic): the most frequent topic of each segment, the smallest among equals; null segments and topics don't count."""
    counted = qa.where(F.col(segment).isNotNull() & F.col("topic").isNotNull()).groupBy(segment, "topic").agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(segment).agg(F.min(F.struct(-F.col("_n"), F.col("topic"))).getField("topic").alias("topic"))


def consistent_topics(qa: DataFrame, segment: str, content: Column) -> DataFrame:
    """QG7: within a segment, a topic of responsibility that is not the most common one becomes the driving topic.

    Topics are counted a segment before the join, and only rows that may change are joined: no window over a hot segment.
    """
    may = F.coalesce(F.col("topic").contains("责任归属") & content.contains("自动驾驶") & F.col(segment).isNotNull(), F.lit(False))
    main = main_topics(qa, segment).withColumnRenamed("topic", "_main")
    changed = qa.where(may).join(main, segment, "left").withColumn("topic", F.when(F.col("topic") != F.col("_main"), F.lit(topics.AUTONOMOUS)).otherwise(F.col("topic")))
    return qa.where(~may).unionByName(changed.select(*qa.columns))


def needs_fix(q: Column, a: Column) -> Column:
    """VL1."""
    q, a = F.coalesce(q, F.lit("")), F.coalesce(a, F.lit(""))
    return (F.length(q) < 10) | contains_any(q, ("》", "《")) | (F.length(a) < 100) | a.contains("===")


def is_sound(q: Column, a: Column) -> Column:
    """VL3; null texts are not."""
    bad = contains_any(q, rules.BAD_PARTS) | contains_any(a, rules.BAD_PARTS)
    return F.coalesce((F.length(q) >= 5) & (F.length(a) >= 50) & ~bad, F.lit(False))


def repair_pairs(qa: DataFrame, segs: DataFrame, segment: str, content: str) -> DataFrame:
    """VL2: pairs that need it get a new question and answer from their segment; ``fixed`` says which.

    Only those pairs are joined, the others pass by; topic and answer are made once a segment, hot segments are one row
    on their side of the join.
    """
    source = with_topic_and_answer(segs.select(segment, content).dropDuplicates([segment]), content).select(segment, F.col("topic").alias("_topic"), F.col("assistant").alias("_answer"))
    weak = needs_fix(F.col("user"), F.col("assistant")) & F.col(segment).isNotNull()
    first = F.create_map(*[F.lit(x) for d, fs in rules.DIMENSIONS.items() for x in (d, rules.TEMPLATES[fs[0]][0])])
    template = F.coalesce(F.try_element_at(first, F.coalesce("dimension", F.lit(""))), F.lit(rules.TEMPLATES["medium"][0]))
    q = F.replace(template, F.lit("{topic}"), F.col("_topic"))
    new = qa.where(weak).join(source, segment, "left").withColumn("fixed", F.col("_answer").isNotNull())
    new = (
        new.withColumn("user", F.when(F.col("fixed"), F.when(q.endswith("？"), q).otherwise(F.concat(q, F.lit("？")))).otherwise(F.col("user")))
        .withColumn("assistant", F.when(F.col("fixed"), F.col("_answer")).otherwise(F.col("assistant")))
        .withColumn("topic", F.when(F.col("fixed"), F.col("_topic")).otherwise(F.col("topic")))
    )
    return qa.where(~weak).withColumn("fixed", F.lit(False)).unionByName(new.select(*qa.columns, "fixed"))


def statistics(qa: DataFrame, segs: DataFrame, segment: str) -> DataFrame:
    """ST1: axis, value, n: pairs by dimension and by difficulty, and the number of segments that have pairs, of all."""
    by = qa.select(F.explode(F.array(F.struct(F.lit("dimension").alias("axis"), F.col("dimension").alias("value")), F.struct(F.lit("difficulty").alias("axis"), F.col("difficulty").alias("value")))).alias("x"))
    counts = by.groupBy("x.axis", "x.value").agg(F.count(F.lit(1)).alias("n"))
    covered = qa.agg(F.lit("segments").alias("axis"), F.lit("covered").alias("value"), F.count_distinct(segment).alias("n"))
    return counts.unionByName(covered).unionByName(segs.agg(F.lit("segments").alias("axis"), F.lit("all").alias("value"), F.count_distinct(segment).alias("n")))
