"""Problem 1: near-duplicate records, by banded signatures and sequential Bayesian verification."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import cut_lineage, enough_partitions, maybe_among, once
from inkmill.llm.components import components

#: A signature has BANDS bands of ROWS 16-bit minimum hashes.  A pair of similarity 0.6 shares a band with probability
#: 1 - (1 - 0.6 ** 4) ** 40 = 0.996, one of 0.65 with 0.9996.
BANDS, ROWS = 40, 4
#: Hashes compared in verification, so many at a time.
STEP, STEPS = 16, 4
#: A candidate is dropped once the posterior probability that it reaches the threshold is below this.
MISS = 1e-4
#: White space in the sense of Python's str.split.
WHITE = "[\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"
#: Characters hashed together.
CHUNK = 2_000_000

_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def signatures(texts: list[str], width: int) -> np.ndarray:
    """(len(texts), BANDS) uint64; each band holds ROWS 16-bit hashes.  Texts must have at least ``width`` characters.

    One-permutation minimum hashing, ROWS times: each pass throws the runs of ``width`` characters into BANDS bins and
    keeps the smallest hash of each; row r of a band comes from pass r, so the rows of a band are independent.  An empty
    bin borrows from the next one that is not.
    """
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    h = np.zeros(len(code) - width + 1, np.uint64)
    for j in range(width):
        h *= np.uint64(0x100000001B3)
        h += code[j : len(code) - width + 1 + j]
    whole = np.ones(len(h), bool)  # runs that don't cross into the next text
    for e in np.cumsum(lens)[:-1]:
        whole[max(0, e - width + 1) : e] = False
    h = _mix(h[whole])
    base = np.repeat(np.arange(len(texts), dtype=np.int64) * BANDS, lens - width + 1)
    out = np.zeros((len(texts), BANDS), np.uint64)
    for row, seed in zip(range(ROWS), _SEEDS):
        y = h ^ np.uint64(seed)
        y *= np.uint64(0xD1342543DE82EF95)
        y ^= y >> np.uint64(32)
        bins = ((y >> np.uint64(32)) * np.uint64(BANDS)) >> np.uint64(32)
        least = np.full(len(texts) * BANDS, 0xFFFFFFFF, np.uint32)
        np.minimum.at(least, base + bins.astype(np.int64), (y & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        least = least.reshape(-1, BANDS)
        value = least.astype(np.uint64)
        empty = least == 0xFFFFFFFF
        for far in range(1, BANDS):
            if not empty.any():
                break
            take = empty & (np.roll(least, -far, 1) != 0xFFFFFFFF)
            value[take] = np.roll(least, -far, 1)[take].astype(np.uint64) + np.uint64(far << 33)
            empty &= ~take
        out |= (_mix(value + np.uint64(seed)) >> np.uint64(48)) << np.uint64(16 * row)
    return out


def needed_matches(threshold: float) -> list[int]:
    """For STEP, 2 STEP, ... compared hashes, the fewest matches at which a pair is kept.

    With a uniform prior, P(similarity >= t | m of n match) = P(Bin(n + 1, t) <= m); the 16-bit hashes' chance
    matches are too rare to count.
    """
    out = []
    for n in range(STEP, STEP * STEPS + 1, STEP):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= MISS:
                break
            m += 1
        out.append(m)
    return out


def shingle_similarity(a: str, b: str, width: int, cache: dict[str, frozenset[str]]) -> float:
    sets = []
    for t in (a, b):
        if t not in cache:
            cache[t] = frozenset(t[i : i + width] for i in range(len(t) - width + 1))
        sets.append(cache[t])
    both = len(sets[0] & sets[1])
    return both / (len(sets[0]) + len(sets[1]) - both)


def bare_texts(df: DataFrame, kind: str, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(kind, id, h, h2, bare): texts without white space of at least min_chars characters and their hashes."""
    bare = F.regexp_replace(F.col(text_col), WHITE, "")
    slim = df.where(F.col(id_col).isNotNull() & (F.length(text_col) >= min_chars)).select(F.lit(kind).alias("kind"), F.col(id_col).cast("long").alias("id"), bare.alias("bare"))
    return slim.where(F.length("bare") >= min_chars).select("kind", "id", F.xxhash64("kind", "bare").alias("h"), F.xxhash64("bare", F.lit(7)).alias("h2"), "bare")


def _signed(texts: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # copies within a batch are signed once: a hot text leaves one row a batch, before any shuffle
            distinct = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            kinds = dict(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
            part: dict[int, str] = {}
            size = 0
            for last, (h, t) in enumerate(distinct.items(), 1):
                part[h] = t
                size += len(t)
                if size >= CHUNK or last == len(distinct):
                    bands = signatures(list(part.values()), width).view(np.int64).ravel()
                    offsets = np.arange(0, len(bands) + 1, BANDS, dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(list(part), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands)), pa.array([kinds[x] for x in part], pa.string())], names=["h", "bands", "kind"])
                    part, size = {}, 0

    return texts.select("h", "bare", "kind").mapInArrow(run, "h long, bands array<long>, kind string")


def _prune(pairs: DataFrame, threshold: float) -> DataFrame:
    needed = needed_matches(threshold)
    longs = STEP * STEPS // ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint16).reshape(-1, longs * ROWS) for i in (2, 3))
            live = np.arange(len(a))
            matches = np.zeros(len(a), np.int64)
            for k, least in enumerate(needed):
                span = slice(k * STEP, (k + 1) * STEP)
                matches[live] += (a[live, span] == b[live, span]).sum(1)
                live = live[matches[live] >= least]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(live)), batch.column(1).take(pa.array(live))], names=["ia", "ib"])

    return pairs.mapInArrow(run, "ia long, ib long")


def _verify(pairs: DataFrame, threshold: float, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cache: dict[str, frozenset[str]] = {}
            keep = []
            for i, (a, b) in enumerate(zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist())):
                if len(cache) > 2000:
                    cache.clear()
                if shingle_similarity(a, b, width, cache) >= threshold:
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in ("ia", "ib", "ha", "hb")], names=["ia", "ib", "ha", "hb"])

    return pairs.mapInArrow(run, "ia long, ib long, ha long, hb long")


def _bands(texts: DataFrame, width: int) -> tuple[DataFrame, DataFrame, int]:
    """Signatures (h, bands, kind, i) of the different texts, written once to the checkpoint folder, their bands (i, key), and the bytes of these.

    ``i`` is a row number and the key has 48 bits: both are mostly small, so that their 40 rows a text shuffle compressed.
    """
    signed = once(cut_lineage(_signed(texts, width).withColumn("i", F.monotonically_increasing_id())), "h")
    bands = signed.select("i", "kind", F.posexplode("bands").alias("band", "part")).select("i", F.shiftrightunsigned(F.xxhash64("kind", "band", "part"), 16).alias("key"))
    return signed, bands, signed.count() * BANDS * 16


def _verified(pairs: DataFrame, signed: DataFrame, texts: DataFrame, threshold: float, width: int) -> DataFrame:
    """(ia, ib, ha, hb) of the pairs (ia, ib) that are similar: pruned by their signatures, then verified on whole texts."""
    head = signed.select("i", F.slice("bands", 1, STEP * STEPS // ROWS).alias("head"))
    compared = pairs.join(head.select(F.col("i").alias("ia"), F.col("head").alias("sa")), "ia").join(head.select(F.col("i").alias("ib"), F.col("head").alias("sb")), "ib")
    alive = cut_lineage(_prune(compared.select("ia", "ib", "sa", "sb"), threshold))
    wanted = alive.select(F.explode(F.array("ia", "ib")).alias("i")).distinct().join(signed.select("i", "h"), "i")
    # an inner join: a semi join would be pushed below the filter
    bodies = maybe_among(texts.select("h", "bare"), "h", wanted.select("h")).join(wanted, "h").dropDuplicates(["h"])
    full = alive.join(bodies.select(F.col("i").alias("ia"), F.col("h").alias("ha"), F.col("bare").alias("ta")), "ia").join(bodies.select(F.col("i").alias("ib"), F.col("h").alias("hb"), F.col("bare").alias("tb")), "ib")
    return cut_lineage(_verify(full.select("ia", "ib", "ha", "hb", "ta", "tb"), threshold, width))


def similar_texts(texts: DataFrame, threshold: float, width: int) -> DataFrame:
    """(ha, hb): the pairs of different texts, each once, whose shingle sets have Jaccard similarity >= threshold.

    1. Each text gets a signature of BANDS x ROWS hashes; copies fold into one.
    2. Texts of one kind that share a band are candidates: an equi-join on the band's hash, in parts of bounded size.
       Spark splits a skewed bucket over tasks and no bucket is gathered in one row.
    3. Signatures are compared STEP hashes at a time and pairs pruned whose posterior probability to reach the
       threshold is below MISS.
    4. Survivors are verified on the whole texts.
    """
    signed, bands, size = _bands(texts, width)
    a, b = bands.select(F.col("i").alias("ia"), "key"), bands.select(F.col("i").alias("ib"), "key")
    with enough_partitions(texts.sparkSession, 2 * size):
        pairs = cut_lineage(a.join(b.hint("merge"), "key").where("ia < ib").select("ia", "ib").distinct())
    return _verified(pairs, signed, texts, threshold, width).select("ha", "hb")


def similar_classes(texts: DataFrame, threshold: float, width: int) -> DataFrame:
    """(h, root): the connected components of the links of ``similar_texts``, without making all of them; root is the number of a class.

    A group of n texts takes about n comparisons, not n * n / 2: first each text is compared with one of each of
    its buckets; what that ties makes classes.  Then only candidates of different classes are left, and of each bucket
    those of its largest class need no comparison with each other: the rest of the bucket is compared with all others of
    other classes.  Every candidate pair is compared or lies in one class, so that no link between classes is lost.
    """
    spark = texts.sparkSession
    signed, bands, size = _bands(texts, width)
    with enough_partitions(spark, size):
        first = cut_lineage(bands.groupBy("key").agg(F.min("i").alias("ia"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "ia"))
        # most buckets hold one text: the others' rows alone are shuffled again
        buckets = cut_lineage(maybe_among(bands, "key", first).join(first, "key"))
    links = _verified(buckets.where("i <> ia").select("ia", F.col("i").alias("ib")).distinct(), signed, texts, threshold, width)
    roots = components(links, "ia", "ib")
    classed = cut_lineage(buckets.join(roots.select(F.col("node").alias("i"), "root"), "i", "left").select("key", "i", F.coalesce("root", "i").alias("c")))
    counted = classed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.max_by("c", F.struct("n", "c")).alias("most")).where("k > 1")
    open_buckets = cut_lineage(classed.join(counted.select("key", "most"), "key"))
    rest = open_buckets.where("c <> most").select("key", F.col("i").alias("x"), F.col("c").alias("cx"))
    across = open_buckets.select("key", F.col("i").alias("y"), F.col("c").alias("cy")).join(rest, "key").where("cx <> cy")
    left = cut_lineage(across.select(F.least("x", "y").alias("ia"), F.greatest("x", "y").alias("ib")).distinct())
    roots = components(links.union(_verified(left, signed, texts, threshold, width)), "ia", "ib")
    return roots.withColumnRenamed("node", "i").join(signed.select("i", "h"), "i").select("h", "root")


def members(texts: DataFrame) -> DataFrame:
    """(kind, id, h, h2) of each record, repeated deliveries counted once."""
    return cut_lineage(texts.select("kind", "id", "h", "h2").distinct())


def similar_pairs(texts: DataFrame, threshold: float, width: int = 5) -> DataFrame:
    """(kind, id_a, id_b), id_a < id_b: all pairs of records of one kind whose texts are equal or similar.

    Texts are those of ``bare_texts``; null, empty and short texts are in no pair.  The result lists every pair of a
    group, so its size is that of the answer; the search itself never pairs copies, which share one signature.
    """
    links, who = similar_texts(texts, threshold, width), members(texts)
    left, right = who.select("kind", F.col("id").alias("x"), F.col("h").alias("ha")), who.select(F.col("id").alias("y"), F.col("h").alias("hb"))
    different = links.join(left, "ha").join(right, "hb").select("kind", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).where("id_a < id_b")
    copied = who.select("kind", F.col("id").alias("id_a"), "h", "h2").join(who.select(F.col("id").alias("id_b"), "h", "h2"), ["h", "h2"]).where("id_a < id_b").select("kind", "id_a", "id_b")
    return different.union(copied).distinct()


def similarity_groups(texts: DataFrame, threshold: float, width: int = 5) -> DataFrame:
    """(kind, id, group_id) of each record that has a similar or equal one.

    Groups are connected components of the links between different texts; group_id is the smallest id in the group.
    Copies are members of their text, never expanded into pairs, and the links within a group are not listed.
    """
    roots, who = similar_classes(texts, threshold, width), members(texts)
    # copies of a text that is similar to no other are a group of their own, by the text's hash
    tagged = who.join(roots, "h", "left").select("kind", "id", F.coalesce(F.concat(F.lit("c"), "root"), F.concat(F.lit("h"), "h")).alias("class"))
    first = tagged.groupBy("kind", "class").agg(F.min("id").alias("group_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return tagged.join(first, ["kind", "class"]).select("kind", "id", "group_id")
