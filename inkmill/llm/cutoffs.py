"""Problem 4: a score cutoff per group that keeps a target fraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.llm.common import cut_lineage, label

#: Relative rank error that the sketch guarantees is 1 / ACCURACY.
ACCURACY = 1000


def _fingerprint(df: DataFrame, seed: int):
    """A hash of all columns in which nulls count; two seeds make 128 bits."""
    parts = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("array"):
            parts += [F.size(c), F.to_json(F.struct(c))]
        elif kind.startswith(("map", "struct")):
            parts.append(F.to_json(F.struct(c)))
        else:
            parts.append(c)
        parts.append(c.isNull())
    return F.xxhash64(F.lit(seed), *parts)


def scored_records(df: DataFrame, id_col: str, group_col: str, score_col: str, targets: DataFrame) -> DataFrame:
    """(id, grp, score) of each scored record of a target group; rows equal in every column count once.

    Null and NaN scores, null groups and groups without a target are left out.  Rows are compared by 128 bits of hash
    over all columns, so that only keys and hashes are shuffled, not texts.
    """
    wanted = targets.select(label(F.col(group_col)).alias("grp")).distinct()
    keyed = df.select(
        F.col(id_col).alias("id"), label(F.col(group_col)).alias("grp"), F.col(score_col).cast("double").alias("score"), _fingerprint(df, 1).alias("h1"), _fingerprint(df, 2).alias("h2")
    ).where("score is not null and not isnan(score)")
    # targets are a small table of settings; without a hint, Spark broadcasts it only below its own size limit
    return keyed.join(wanted, "grp", "left_semi").dropDuplicates(["id", "h1", "h2"]).select("id", "grp", "score")


def cutoffs(scored: DataFrame, targets: DataFrame) -> DataFrame:
    """One row a target: grp, keep_percent, records, wanted, cutoff, kept.

    The cutoff is the highest score at or above which at least keep_percent of the group's records lie; all records
    tied at the cutoff are kept.  keep_percent <= 0 or a group without scored records keeps nothing (cutoff null).

    1. A quantile sketch with guaranteed rank error gives two scores that bracket the target rank.
    2. One aggregation counts the records above the bracket and checks that the rank lies inside (if it did not, the
       bracket is widened to the whole group, so the result is always exact).
    3. Only the bracketed scores, one row each distinct value, are sorted.
    """
    t = targets.groupBy("grp").agg(F.max("keep_percent").alias("keep_percent"))
    n = scored.groupBy("grp").agg(F.count(F.lit(1)).alias("records"))
    goal = t.join(n, "grp", "left").withColumn("records", F.coalesce("records", F.lit(0)))
    goal = goal.withColumn("wanted", F.greatest(F.lit(0), F.least(F.col("records"), F.ceil(F.col("records") * F.col("keep_percent") / 100))).cast("long"))
    grid = scored.groupBy("grp").agg(F.percentile_approx("score", [i / 200 for i in range(201)], ACCURACY).alias("q"))
    # place of the wanted rank on the grid, counted from below; two steps and the sketch's error to each side
    low = F.floor((1 - F.col("wanted") / F.col("records") - 2.0 / ACCURACY) * 200) - 1
    high = F.ceil((1 - F.col("wanted") / F.col("records") + 2.0 / ACCURACY) * 200) + 1
    bracket = (
        goal.join(grid, "grp")
        .where("wanted > 0")
        .withColumn("lo", F.when(low <= 0, F.lit(float("-inf"))).otherwise(F.get("q", low.cast("int"))))
        .withColumn("hi", F.when(high >= 200, F.lit(float("inf"))).otherwise(F.get("q", high.cast("int"))))
        .select("grp", "wanted", "lo", "hi")
    )
    bracket = cut_lineage(bracket)  # as many rows as targets
    counted = scored.join(bracket, "grp").groupBy("grp").agg(F.count_if(F.col("score") > F.col("hi")).alias("above"), F.count_if(F.col("score") >= F.col("lo")).alias("upto"))
    sound = (F.col("above") < F.col("wanted")) & (F.col("upto") >= F.col("wanted"))
    bracket = bracket.join(counted, "grp").select(
        "grp", "wanted", F.when(sound, F.col("lo")).otherwise(F.lit(float("-inf"))).alias("lo"), F.when(sound, F.col("hi")).otherwise(F.lit(float("inf"))).alias("hi"), F.when(sound, F.col("above")).otherwise(F.lit(0)).alias("above")
    )
    inside = scored.join(bracket, "grp").where(F.col("score").between(F.col("lo"), F.col("hi"))).groupBy("grp", "wanted", "above", "score").agg(F.count(F.lit(1)).alias("n"))
    upto = F.col("above") + F.sum("n").over(Window.partitionBy("grp").orderBy(F.desc("score")))
    found = inside.withColumn("upto", upto).where("upto >= wanted").groupBy("grp").agg(F.max("score").alias("cutoff"), F.min("upto").alias("kept"))
    return goal.join(found, "grp", "left").select("grp", "keep_percent", "records", "wanted", "cutoff", F.coalesce("kept", F.lit(0)).alias("kept"))


def kept(scored: DataFrame, cuts: DataFrame) -> DataFrame:
    """The records at or above their group's cutoff."""
    return scored.join(cuts.select("grp", "cutoff"), "grp").where("score >= cutoff")
