"""Shared pieces of the training-data operators: tables, checkpoints, labels, exact hash-rank cuts."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys are 62-bit so that sums and fractions of them stay inside LONG and exact in comparisons.
KEY_SPACE = 1 << 62


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the session's spark.checkpoint.dir; where neither it nor a directory is set, a temporary one in local mode (tests), an error on a cluster."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="inkmill-ckpt-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and read it from there: it survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def strip_ws(c: Column) -> Column:
    """Strip Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def label(c: Column, lower: bool = False) -> Column:
    return F.lower(strip_ws(c)) if lower else strip_ws(c)


def settings(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """run_settings, a table of a few rows that does not grow."""
    return {r.setting: r.setting_value for r in table(spark, sf_dir, "run_settings").collect()}


def random_key(seed: int, *cols: Column) -> Column:
    """A uniform pseudo-random LONG in [0, KEY_SPACE), the same on every run."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 2)


def rank_thresholds(rows: DataFrame, cell: list[str], cuts: DataFrame, key: str = "_key", tie: str = "_tie") -> DataFrame:
    """Exact order statistics of uniform keys for many cells, without sorting a cell.

    ``cuts`` has the cell columns, ``cut`` (any id), ``n`` (rows of the cell) and ``k`` (0..n); its size must be
    bounded by the caller, it is broadcast.  Result: cuts plus ``at_key``, ``at_tie``: the k-th smallest (key, tie) of
    the cell, so that exactly k rows compare <= it (rows equal in both count together); null for k = 0.

    Keys are uniform, so the k-th smallest lies with overwhelming probability within 8 standard deviations of k/n:
    rows below that bracket are only counted and only the bracket, O(sqrt(n)) rows, is ranked.  If a bracket misses,
    the whole cell is ranked instead, so the result is always exact.
    """
    p = F.col("k") / F.greatest(F.col("n"), F.lit(1))
    half = 8.0 * F.sqrt(p * (1 - p) / F.greatest(F.col("n"), F.lit(1))) + 16.0 / F.greatest(F.col("n"), F.lit(1))
    wanted = (
        cuts.where("k > 0")
        .withColumn("_lo", (F.greatest(p - half, F.lit(0.0)) * float(KEY_SPACE)).cast("long"))
        .withColumn("_hi", (F.least(p + half, F.lit(1.0)) * float(KEY_SPACE)).cast("long"))
    )
    slim = rows.select(*cell, key, tie)

    def ranked(part: DataFrame) -> DataFrame:
        from pyspark.sql import Window

        w = Window.partitionBy(*cell, "cut").orderBy(key, tie)
        return part.withColumn("_rank", F.row_number().over(w) + F.col("_below")).where("_rank = k")

    pairs = slim.join(F.broadcast(wanted), cell)
    counted = pairs.groupBy(*cell, "cut").agg(
        F.count_if(F.col(key) < F.col("_lo")).alias("_below"), F.count_if(F.col(key) <= F.col("_hi")).alias("_upto")
    )
    bounded = wanted.join(F.broadcast(counted), [*cell, "cut"])
    sound = F.col("_below") < F.col("k")
    sound = sound & (F.col("_upto") >= F.col("k"))
    bounded = (
        bounded.withColumn("_lo", F.when(sound, F.col("_lo")).otherwise(F.lit(0)))
        .withColumn("_hi", F.when(sound, F.col("_hi")).otherwise(F.lit(KEY_SPACE)))
        .withColumn("_below", F.when(sound, F.col("_below")).otherwise(F.lit(0)))
    )
    inside = slim.join(F.broadcast(bounded), cell).where(F.col(key).between(F.col("_lo"), F.col("_hi")))
    found = ranked(inside).select(*cell, "cut", F.col(key).alias("at_key"), F.col(tie).alias("at_tie"))
    return cuts.join(F.broadcast(found), [*cell, "cut"], "left")


#: Parts of the key space that are totalled to find in which one a running total lies.
CUT_BINS_LOG2 = 14


def weighted_cuts(rows: DataFrame, cell: list[str], cuts: DataFrame, weight: str, key: str = "_key", tie: str = "_tie") -> DataFrame:
    """(cut, at_key, at_tie, reached) where the running total of ``weight`` in the order of (key, tie) comes nearest to ``cuts.at``.

    ``cuts`` has the cell columns, ``cut`` (a unique number) and ``at`` (a total); its size must be bounded by the
    caller, it is broadcast.  Rows up to (at_key, at_tie) weigh ``reached``, the nearest total that whole rows give.

    Exact without sorting a cell: the key space is cut into 2 ** CUT_BINS_LOG2 bins, whose totals are summed up (a window over bins,
    not rows); only the bin in which a cut lies, that share of the cell for uniform keys, is ordered.
    """
    from pyspark.sql import Window

    binned = rows.select(*cell, F.col(weight).alias("_weight"), F.col(key).alias("_k"), F.col(tie).alias("_t"), F.shiftrightunsigned(key, 62 - CUT_BINS_LOG2).alias("_bin"))
    wanted = F.broadcast(cuts.select(*cell).distinct())
    totals = binned.join(wanted, cell, "left_semi").groupBy(*cell, "_bin").agg(F.sum("_weight").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy(*cell).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = totals.withColumn("_before", before).join(F.broadcast(cuts), cell).where("_before < at and at <= _before + _sum").select(*cell, "_bin", "_before", "cut", "at")
    marked = cut_lineage(marked)  # as many rows as cuts
    inside = binned.join(F.broadcast(marked), [*cell, "_bin"])
    total = F.col("_before") + F.sum("_weight").over(Window.partitionBy(*cell, "cut").orderBy("_k", "_t"))
    near = inside.withColumn("_total", total).groupBy("cut").agg(F.min_by(F.struct("_k", "_t", "_total"), F.struct(F.abs(F.col("_total") - F.col("at")), "_k", "_t")).alias("_x"))
    found = marked.join(F.broadcast(near), "cut")
    early = F.col("at") - F.col("_before") < F.abs(F.col("_x._total") - F.col("at"))  # nearest with no row of the bin
    start = F.col("_bin") * F.lit(1 << (62 - CUT_BINS_LOG2)) - 1
    return found.select("cut", F.when(early, start).otherwise(F.col("_x._k")).alias("at_key"), F.when(~early, F.col("_x._t")).alias("at_tie"), F.when(early, F.col("_before")).otherwise(F.col("_x._total")).alias("reached"))


#: Words of 64 bits in a membership filter: the broadcast has at most so many rows of two LONGs, whatever the keys.
FILTER_WORDS = 1 << 20


def _word(c: Column) -> Column:
    return c.bitwiseAND(FILTER_WORDS - 1)


def _bit(c: Column) -> Column:
    return F.shiftrightunsigned(c, 20).bitwiseAND(63).cast("int")


def filter_words(keys: DataFrame, key: str) -> DataFrame:
    """(_word, _bits) of a one-hash Bloom filter of FILTER_WORDS x 64 bits over the LONG hashes ``key``, the keys folded into words by bit_or."""
    return keys.select(_word(F.col(key)).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col(key))).alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def maybe_among(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of df whose LONG hash ``key`` may be among ``keys.key``; drops most others before a shuffle of df.

    The exact join still has to follow.  With more keys than bits it lets everything through.
    """
    tagged = df.withColumn("_word", _word(F.col(key))).join(F.broadcast(filter_words(keys, key)), "_word")
    return tagged.where(F.call_function("getbit", F.col("_bits"), _bit(F.col(key))) == 1).drop("_word", "_bits")


def once(df: DataFrame, key: str, *more: str) -> DataFrame:
    """df with one row a LONG hash ``key`` (and ``more`` columns, such as further bits of hash), of copies the smallest values.

    Only rows whose key may occur twice are shuffled: keys are counted first, those of copies go into a filter of bounded
    size, and what it rules out passes straight through.  A hot key folds in its tasks before the shuffle.
    """
    twice = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    tagged = df.withColumn("_word", _word(F.col(key))).join(F.broadcast(filter_words(twice, key)), "_word", "left")
    tagged = tagged.withColumn("_maybe", F.coalesce(F.call_function("getbit", F.col("_bits"), _bit(F.col(key))) == 1, F.lit(False)))
    copies = tagged.where("_maybe").groupBy(key, *more).agg(*[F.min(c).alias(c) for c in df.columns if c not in (key, *more)])
    return tagged.where("not _maybe").select(*df.columns).union(copies.select(*df.columns))


def distinct_texts(df: DataFrame, text_col: str) -> DataFrame:
    """(text_col) each different text once (equal 128 bits of hash are one text), null texts left out; copies alone are shuffled."""
    texts = df.where(F.col(text_col).isNotNull()).select(text_col, F.xxhash64(text_col).alias("_h"), F.xxhash64(F.lit(1), text_col).alias("_h2"))
    return once(texts, "_h", "_h2").select(text_col)


#: Bytes of rows that a task of a large join should read, and the most tasks that it is split into.
TASK_BYTES, MOST_TASKS = 16 << 20, 50_000


@contextmanager
def enough_partitions(spark: SparkSession, size: int) -> Iterator[None]:
    """Within it, eager steps shuffle ``size`` bytes into parts of about TASK_BYTES, but never into fewer than the session says."""
    name = "spark.sql.shuffle.partitions"
    own = spark.conf.get(name)
    spark.conf.set(name, str(max(int(own), min(MOST_TASKS, size // TASK_BYTES))))
    try:
        yield
    finally:
        spark.conf.set(name, own)
