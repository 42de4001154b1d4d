"""Problem 2: a sample whose category shares match given targets."""

from __future__ import annotations

from math import floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import label, random_key, rank_thresholds


def allocate(shares: list[float], floors: list[int], available: list[int], total: int) -> list[int]:
    """Integer quotas by largest remainder, at least the floor and at most what is available.

    Every cell first gets min(floor, available).  The rest of ``total`` is spread over the cells in proportion to
    their shares; a cell that would go beyond what it has or below its floor is fixed there and the others share again.
    Fractions are rounded by largest remainder, ties by position.  With floors beyond ``total`` the floors win.
    """
    n = len(shares)
    low = [min(f, a) for f, a in zip(floors, available)]
    fixed: dict[int, int] = {}
    while True:
        free = [i for i in range(n) if i not in fixed]
        left = max(0, total - sum(fixed.values()))
        weight = sum(shares[i] for i in free)
        ideal = {i: (left * shares[i] / weight if weight > 0 else 0.0) for i in free}
        over = [i for i in free if ideal[i] > available[i]]
        under = [i for i in free if ideal[i] < low[i]]
        # the side with the larger total violation is fixed first, as in bounded water filling
        excess, lack = sum(ideal[i] - available[i] for i in over), sum(low[i] - ideal[i] for i in under)
        if not over and not under:
            break
        fixed |= {i: available[i] for i in over} if excess >= lack else {i: low[i] for i in under}
    quota = dict(fixed) | {i: floor(ideal[i]) for i in free}
    rest = min(max(0, total - sum(quota.values())), len(free))
    for i in sorted(free, key=lambda i: (-(ideal[i] - floor(ideal[i])), i)):
        if rest and quota[i] < available[i]:
            quota[i] += 1
            rest -= 1
    return [quota[i] for i in range(n)]


def plan_sample(df: DataFrame, targets: DataFrame, fraction: float) -> DataFrame:
    """One row a target cell: dimension, difficulty, target_share, min_rows, available, wanted, quota, short.

    ``wanted`` is the larger of min_rows and share x floor(fraction x all rows); ``short`` is wanted - available where
    that is positive, else 0.  Labels are compared without white space at the ends, difficulty in lower case; rows
    with a null label belong to no cell.  An empty table gives quota 0 everywhere.  Repeated target rows are planned
    once.  Target cells with a null label are dropped.  The targets, a table of settings, are planned on the driver.
    """
    spark = df.sparkSession
    counted = (
        df.groupBy(label(F.col("dimension")).alias("_dim"), label(F.col("difficulty"), lower=True).alias("_dif"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    cells = targets.select("dimension", "difficulty", "target_share", "min_rows").dropna(subset=["dimension", "difficulty"]).distinct()
    cells = cells.withColumn("_dim", label(F.col("dimension"))).withColumn("_dif", label(F.col("difficulty"), lower=True))
    total = counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_all"))
    got = (
        cells.join(counted, ["_dim", "_dif"], "left")
        .crossJoin(F.broadcast(total))  # one row
        .select("dimension", "difficulty", F.coalesce("target_share", F.lit(0.0)).alias("share"), F.coalesce("min_rows", F.lit(0)).alias("least"), F.coalesce("_n", F.lit(0)).alias("n"), "_all")
        .orderBy("dimension", "difficulty", "share", "least")
        .collect()
    )
    size = floor(fraction * got[0]._all) if got else 0
    quotas = allocate([r.share for r in got], [r.least for r in got], [r.n for r in got], size)
    rows = [
        (r.dimension, r.difficulty, r.share, r.least, r.n, w := max(float(r.least), r.share * size), q, max(0.0, w - r.n))
        for r, q in zip(got, quotas)
    ]
    return spark.createDataFrame(
        rows, "dimension string, difficulty string, target_share double, min_rows int, available long, wanted double, quota long, short double"
    )


def shortfalls(plan: DataFrame) -> DataFrame:
    """The cells that fall short: fewer rows than wanted."""
    return plan.where("available < wanted")


def proportional_sample(df: DataFrame, plan: DataFrame, id_col: str, seed: int = 17) -> DataFrame:
    """The rows of the sample: in each cell the ``quota`` rows of smallest random key.

    Random keys hash the seed and the id.  Rows repeated under one id have one key: all of them are taken or none, so
    a cell can get a few rows more where ids repeat.  Extra columns are kept; columns whose names begin with an
    underscore and clash with the operator's own (_dim, _dif, _key, _tie) are not supported.
    """
    cell = ["_dim", "_dif"]
    keyed = (
        df.withColumn("_dim", label(F.col("dimension")))
        .withColumn("_dif", label(F.col("difficulty"), lower=True))
        .withColumn("_key", random_key(seed, F.col(id_col)))
        .withColumn("_tie", F.col(id_col))
    )
    cuts = plan.select(
        label(F.col("dimension")).alias("_dim"), label(F.col("difficulty"), lower=True).alias("_dif"), F.lit(0).alias("cut"), F.col("available").alias("n"), F.col("quota").alias("k")
    )
    at = rank_thresholds(keyed, cell, cuts).select(*cell, "at_key", "at_tie").dropna()
    inside = (F.col("_key") < F.col("at_key")) | ((F.col("_key") == F.col("at_key")) & (F.col("_tie") <= F.col("at_tie")))
    return keyed.join(F.broadcast(at), cell).where(inside).drop(*cell, "_key", "_tie", "at_key", "at_tie")
