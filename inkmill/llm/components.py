"""Problem 5: connected components and splits that keep related records together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import cut_lineage, random_key, rank_thresholds
from inkmill.llm.mixing import Flow

#: Labels that count for themselves, the most frequent ones; the others count as one.
LABELS = 64
#: Components of up to so many rows are bundled by their size; larger ones by classes of size, so many an octave.  So
#: there are at most (SIZES + CLASSES x 40) x (LABELS + 1) bundles, whatever the data: they are planned on the driver and broadcast.
SIZES, CLASSES = 512, 32
#: Cost of a row beyond the quota of its split, against 1 for one beyond that of its label in the split.
DEVIATION = 10.0
#: Components of more than this share of all rows are placed one by one before the flow is solved.
LARGE = 0.01


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every id named in a link of two different ids; root is the smallest id tied to it.

    Alternating large-star and small-star rounds (Kiveris et al. 2014), each a groupBy-min and a join with a checkpoint
    after it; only a count and a checksum come to the driver.  Null ends and self links tie nothing; an empty table
    gives no rows.
    """
    u, v = F.col(a).cast("long"), F.col(b).cast("long")
    edges = links.where(u.isNotNull() & v.isNotNull() & (u != v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    edges = cut_lineage(edges)
    before = None
    while True:
        # large star: every larger neighbour is tied to the smallest of the neighbourhood
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every smaller neighbour and the node itself are tied to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = cut_lineage(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def tied_groups(records: DataFrame, entity: str, comps: DataFrame) -> DataFrame:
    """(entity, group_id) of the entities that have records and share a component with another one that has."""
    present = records.where(F.col(entity).isNotNull()).select(F.col(entity).cast("long").alias("node")).distinct()
    inside = present.join(comps, "node")
    many = inside.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return inside.join(many, "root").select(F.col("node").alias("entity"), F.col("root").alias("group_id"))


def flow_plan(bundles: list[tuple[float, str, int]], shares: list[float]) -> list[list[int]]:
    """How many components of each bundle (size, label, count) go to each split.

    1. Components of more than LARGE of all rows are placed first, one by one, where they deviate least.
    2. Minimum-cost flow in rows: source, labels, (label, split), splits, sink.  Each split has a quota of all rows and
       each (label, split) a quota of the label's rows, less what step 1 placed; rows beyond a quota go over a second
       arc at a cost of deviation, DEVIATION a row for splits and 1 for labels.  Bundles of a label have the same arcs, so they enter the network as one node
       with their rows in total and share its flow in proportion.
    3. The flow is rounded to whole components from large bundles to small ones: what a bundle's rounding gives a split too
       much or too little, of its label and overall, is carried on, and remainders go to the splits that are owed most, so
       that small components even out what large ones leave.
    """
    k = len(shares)
    out = [[0] * k for _ in bundles]
    weight = sum(shares)
    if weight <= 0:
        return out
    total = sum(s * c for s, _, c in bundles)
    labels = sorted({lab for _, lab, _ in bundles})
    by_label = dict.fromkeys(labels, 0.0)
    for s, lab, c in bundles:
        by_label[lab] += s * c
    left = [total * x / weight for x in shares]
    left_label = {lab: [n * x / weight for x in shares] for lab, n in by_label.items()}
    open_splits = [j for j in range(k) if shares[j] > 0]
    order = sorted(range(len(bundles)), key=lambda i: (-bundles[i][0], bundles[i][1]))
    large = [i for i in order if bundles[i][0] > LARGE * total]
    for i in large:  # at most 1 / LARGE components
        size, lab, count = bundles[i]
        for _ in range(count):
            j = min(open_splits, key=lambda j: (DEVIATION * max(0.0, size - max(0.0, left[j])) + max(0.0, size - max(0.0, left_label[lab][j])), -left[j] / shares[j]))
            out[i][j] += 1
            left[j] -= size
            left_label[lab][j] -= size
    rest = [i for i in order if i not in set(large)]
    rows = dict.fromkeys(labels, 0.0)
    for i in rest:
        rows[bundles[i][1]] += bundles[i][0] * bundles[i][2]
    flow, arcs = Flow(2 + k + len(labels) * (k + 1)), {}
    for j in open_splits:
        flow.arc(2 + j, 1, max(0.0, left[j]), 0.0)
        flow.arc(2 + j, 1, total, DEVIATION)
    for n, lab in enumerate(labels):
        node = 2 + k + n * (k + 1)
        flow.arc(0, node, rows[lab], 0.0)
        for j in open_splits:
            arcs[lab, j] = (flow.arc(node, node + 1 + j, max(0.0, left_label[lab][j]), 0.0), flow.arc(node, node + 1 + j, total, 1.0))
            flow.arc(node + 1 + j, 2 + j, total, 0.0)
    flow.run(0, 1)
    share = {(lab, j): (flow.room[a ^ 1] + flow.room[b ^ 1]) / max(rows[lab], 1e-9) for (lab, j), (a, b) in arcs.items()}
    owed_label = {lab: [0.0] * k for lab in labels}
    owed = [0.0] * k

    def give(i: int, j: int, n: int) -> None:
        out[i][j] += n
        owed[j] -= n * bundles[i][0]
        owed_label[bundles[i][1]][j] -= n * bundles[i][0]

    for i in rest:
        size, lab, count = bundles[i]
        mine = owed_label[lab]
        for j in open_splits:
            due = size * count * share[lab, j]
            mine[j] += due
            owed[j] += due
        spare = count
        for j in open_splits:
            give(i, j, min(spare, max(0, int(min(mine[j], owed[j]) // size))))
            spare = count - sum(out[i])
        # what is left makes the splits' debts equal
        high = sorted(open_splits, key=lambda j: -owed[j])
        for n in range(len(high), 0, -1):
            level = (sum(owed[j] for j in high[:n]) - spare * size) / n
            if level <= owed[high[n - 1]]:
                break
        for j in high[:n]:
            give(i, j, min(count - sum(out[i]), max(0, int((owed[j] - level) // size))))
        for _ in range(count - sum(out[i])):  # fewer than there are splits
            give(i, max(open_splits, key=lambda j: (owed[j], mine[j], shares[j])), 1)
    return out


def size_class(size: Column) -> Column:
    """The size itself up to SIZES, beyond it the number of its class, of which CLASSES make an octave."""
    return F.when(size <= SIZES, size).otherwise(SIZES + 1 + F.floor((F.log2(size.cast("double")) - F.log2(F.lit(float(SIZES)))) * CLASSES)).cast("long")


def entity_splits(records: DataFrame, id_col: str, entity: str, label_col: str, links: DataFrame, a: str, b: str, targets: DataFrame, seed: int = 29) -> DataFrame:
    """(id, entity, group_id, split_name) of every record; records of one entity or of tied entities never part.

    Records without an entity stand alone.  Components are bundled by (class of size, most frequent label); ``flow_plan``
    sets how many components of each bundle go where, and the members are chosen by smallest hash of the component.  Rows
    repeated under one id without an entity fall into one component.  Targets, a table of settings, with no positive
    share get nothing; an empty table gives no rows.  Only bundles, of bounded number, come to the driver.
    """
    spark = records.sparkSession
    comps = components(links, a, b)
    rows = records.select(F.col(id_col).alias("id"), F.col(entity).cast("long").alias("entity"), F.coalesce(F.lower(F.trim(F.col(label_col))), F.lit("")).alias("lab"))
    common = rows.groupBy("lab").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "lab").limit(LABELS).select("lab", F.col("lab").alias("_lab"))
    rows = rows.join(F.broadcast(common), "lab", "left").withColumn("lab", F.coalesce("_lab", F.lit("other labels"))).drop("_lab")
    # counted by entity before the join, so that a hot entity is one row on each side of it
    single = rows.where("entity is null").select(F.concat(F.lit("r"), F.col("id")).alias("comp"), "lab", F.lit(1).cast("long").alias("n"))
    counted = rows.where("entity is not null").groupBy("entity", "lab").agg(F.count(F.lit(1)).alias("n"))
    tied = counted.join(comps.select(F.col("node").alias("entity"), "root"), "entity", "left").select(F.concat(F.lit("e"), F.coalesce("root", "entity")).alias("comp"), "lab", "n")
    per_label = single.unionByName(tied).groupBy("comp", "lab").agg(F.sum("n").alias("n"))
    sized = per_label.groupBy("comp").agg(F.sum("n").alias("rows"), F.max(F.struct(F.col("n"), F.col("lab"))).getField("lab").alias("lab"))
    sized = cut_lineage(sized.withColumn("size", size_class(F.col("rows"))).withColumn("_key", random_key(seed, F.col("comp"))).withColumn("_tie", F.col("comp")))
    bundles = sized.groupBy("size", "lab").agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows")).orderBy("size", "lab").collect()
    splits = [(r.split_name, max(0.0, r.target_share or 0.0)) for r in targets.groupBy("split_name").agg(F.max("target_share").alias("target_share")).orderBy(F.desc("target_share"), "split_name").collect()]
    plan = flow_plan([(r.rows / r.n, r.lab, r.n) for r in bundles], [s for _, s in splits])
    cuts = []
    for r, take in zip(bundles, plan):
        upto = 0
        for j, n in enumerate(take):
            upto += n
            if n:
                cuts.append((r["size"], r.lab, j, r.n, upto, splits[j][0]))
    cuts_df = spark.createDataFrame(cuts, "size long, lab string, cut int, n long, k long, split_name string")
    at = rank_thresholds(sized, ["size", "lab"], cuts_df).where("at_key is not null")
    within = (F.col("_key") < F.col("at_key")) | ((F.col("_key") == F.col("at_key")) & (F.col("_tie") <= F.col("at_tie")))
    assigned = cut_lineage(
        sized.join(F.broadcast(at), ["size", "lab"]).where(within).groupBy("comp").agg(F.min(F.struct("cut", "split_name")).getField("split_name").alias("split_name"))
    )
    of_records = rows.where("entity is null").select("id", "entity", F.concat(F.lit("r"), F.col("id")).alias("comp"), F.lit(None).cast("long").alias("group_id"))
    of_entities = rows.where("entity is not null").join(comps.select(F.col("node").alias("entity"), "root"), "entity", "left").select(
        "id", "entity", F.concat(F.lit("e"), F.coalesce("root", "entity")).alias("comp"), F.coalesce("root", "entity").alias("group_id")
    )
    return of_records.unionByName(of_entities).join(assigned, "comp").select("id", "entity", "group_id", "split_name")
