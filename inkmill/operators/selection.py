"""SL*: high-quality records, balanced over categories, and the final list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def above(scored: DataFrame, least: float = 85.0, score: str = "total_score") -> DataFrame:
    """SL1."""
    return scored.where(F.col(score) >= least)


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """SL2: category, n; missing labels are 'unknown'."""
    return df.groupBy(F.coalesce(column, F.lit("unknown")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


def _lacking(counts: DataFrame) -> DataFrame:
    """SL3: categories at the minimum, and whether the axis is out of balance (minimum below a third of the maximum)."""
    stats = counts.agg(F.min("n").alias("least"), F.max("n").alias("most"))
    return counts.crossJoin(F.broadcast(stats)).where("n = least").select("category", (F.col("least") < F.col("most") / 3).alias("uneven"))  # stats is one row


def balanced(scored: DataFrame, order: list[str], least: float = 85.0, extras: int = 20, score: str = "total_score") -> DataFrame:
    """SL3-4: records above the threshold, and if either axis is out of balance up to ``extras`` records at most ten
    points below it from the categories at the minimum of either axis; ``extra`` marks these.

    The category tables have a row a category; they are joined, not collected.
    """
    high = above(scored, least, score)
    axes = ("dimension", "difficulty")
    low = [_lacking(category_counts(high, c)) for c in axes]
    uneven = low[0].unionByName(low[1]).agg(F.coalesce(F.max("uneven"), F.lit(False)).alias("_uneven"))
    pool = scored.where((F.col(score) >= least - 10) & (F.col(score) < least))
    marked = pool
    for c, lacking in zip(axes, low):
        marked = marked.join(lacking.select(F.col("category").alias(f"_{c}")), F.coalesce(c, F.lit("unknown")) == F.col(f"_{c}"), "left")
    wanted = marked.where(" or ".join(f"_{c} is not null" for c in axes)).crossJoin(F.broadcast(uneven)).where("_uneven").drop("_uneven", *[f"_{c}" for c in axes])  # uneven is one row
    top = wanted.orderBy(F.desc(score), *order).limit(extras)
    return high.withColumn("extra", F.lit(False)).unionByName(top.withColumn("extra", F.lit(True)))


def final_list(df: DataFrame, key: list[str], size: int = 200, seed: int = 3, score: str = "total_score") -> DataFrame:
    """SL5-6: the ``size`` best records, ties in seeded random order: a distributed top-k, no full sort."""
    return df.orderBy(F.desc(score), F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])), *key).limit(size)
