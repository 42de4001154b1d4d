"""The pN_ queries and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import components as comp
from inkmill.llm import cutoffs as cut
from inkmill.llm import encoding, mixing, neardup, pairs, pieces, sampling, truncation
from inkmill.llm.common import label, settings, table


def _p1(spark: SparkSession, d: str):
    s = settings(spark, d)
    least = int(s["similarity_min_chars"])
    qa = neardup.bare_texts(table(spark, d, "qa_instructions_robust"), "qa", "qa_id", "assistant", least)
    return qa.union(neardup.bare_texts(table(spark, d, "segmented_content"), "segment", "segment_id", "content", least)), s["similarity_min"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.similar_pairs(*_p1(spark, d))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.similarity_groups(*_p1(spark, d))


def _p2(spark: SparkSession, d: str):
    qa = table(spark, d, "qa_instructions_robust")
    return qa, sampling.plan_sample(qa, table(spark, d, "sample_targets"), settings(spark, d)["sample_fraction"])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return sampling.shortfalls(_p2(spark, d)[1]).select("dimension", "difficulty")


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return _p2(spark, d)[1]


def p2_sample(spark: SparkSession, d: str) -> DataFrame:
    qa, plan = _p2(spark, d)
    return sampling.proportional_sample(qa.select("qa_id", "dimension", "difficulty"), plan, "qa_id")


def _p3(spark: SparkSession, d: str) -> DataFrame:
    s = settings(spark, d)
    return pieces.oversized_pieces(table(spark, d, "segmented_content"), "segment_id", "content", int(s["piece_limit"]), int(s["piece_overlap"]))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    forced = _p3(spark, d).groupBy("segment_id", "content_hash").agg(F.bool_or("forced").alias("forced"))
    return forced.select("segment_id", F.when(F.col("forced"), "forced").otherwise("natural").alias("cut")).distinct()


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _p3(spark, d).drop("content_hash")


def _p4(spark: SparkSession, d: str):
    targets = table(spark, d, "keep_targets")
    scored = cut.cut_lineage(cut.scored_records(table(spark, d, "high_quality_qa"), "qa_id", "dimension", "total_score", targets))
    return scored, cut.cutoffs(scored, targets.select(label(F.col("dimension")).alias("grp"), "keep_percent"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    scored, cuts = _p4(spark, d)
    return cut.kept(scored, cuts).select(F.col("id").alias("qa_id")).distinct()


def p4_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    return _p4(spark, d)[1].withColumnRenamed("grp", "dimension")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    comps = comp.components(table(spark, d, "segment_links"), "segment_id", "linked_segment_id")
    groups = comp.tied_groups(table(spark, d, "qa_instructions_robust"), "segment_id", comps)
    return groups.select(F.col("entity").cast("int").alias("segment_id"), F.col("group_id").cast("int").alias("group_id"))


def p5_splits(spark: SparkSession, d: str) -> DataFrame:
    out = comp.entity_splits(
        table(spark, d, "qa_instructions_robust"), "qa_id", "segment_id", "difficulty", table(spark, d, "segment_links"), "segment_id", "linked_segment_id", table(spark, d, "split_targets")
    )
    return out.select(F.col("id").alias("qa_id"), F.col("entity").alias("segment_id"), "group_id", "split_name")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    got = p5_splits(spark, d).groupBy("split_name").agg(F.count(F.lit(1)).alias("records"))
    total = got.agg(F.sum("records").alias("_all"))
    return table(spark, d, "split_targets").join(got, "split_name", "left").crossJoin(F.broadcast(total)).withColumn("share", F.try_divide("records", F.col("_all"))).drop("_all")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    model = pairs.fit_languages(table(spark, d, "documents"))
    return pairs.defects(table(spark, d, "qa_instructions_robust"), "qa_id", "user", "assistant", model)


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.encode_texts(table(spark, d, "documents"), "doc_id", "text")


def _p8(spark: SparkSession, d: str):
    return mixing.sized_documents(table(spark, d, "documents")), table(spark, d, "mix_targets"), settings(spark, d)["mix_fraction"]


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.capacities(*_p8(spark, d)).where("short").select("source")


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(*_p8(spark, d))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    sized, targets, fraction = _p8(spark, d)
    return mixing.mix_report(sized, targets, fraction, mixing.mix(sized, targets, fraction))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "documents").select("doc_id", "text"))


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return truncation.truncation_report(docs, truncation.truncated(docs.select("doc_id", "text")))


def queries():
    return {name: f for name, f in globals().items() if name[0] == "p" and name[1].isdigit()}


#: White space at either end, as the labels are compared.
_WS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _trim(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_WS}', ''), '{_WS}$', '')"


_SETTING = "(SELECT setting_value FROM run_settings WHERE setting = '{}')"


def oracle_sql() -> dict[str, str]:
    dim, dif = _trim("dimension"), f"lower({_trim('difficulty')})"
    fraction, limit, mixed = _SETTING.format("sample_fraction"), _SETTING.format("piece_limit"), _SETTING.format("mix_fraction")
    cells = f"""
        WITH q AS (SELECT {dim} AS dim, {dif} AS dif, count(*) AS n FROM qa_instructions_robust GROUP BY ALL),
        total AS (SELECT floor({fraction} * count(*)) AS size FROM qa_instructions_robust),
        c AS (SELECT t.dimension, t.difficulty, greatest(t.min_rows, t.target_share * size) AS wanted, coalesce(n, 0) AS available
              FROM (SELECT DISTINCT * FROM sample_targets) t CROSS JOIN total LEFT JOIN q ON dim = {_trim('t.dimension')} AND dif = lower({_trim('t.difficulty')}))"""
    scored = f"""
        WITH s AS (SELECT qa_id, {dim} AS dimension, total_score FROM (SELECT DISTINCT * FROM high_quality_qa) WHERE total_score IS NOT NULL AND NOT isnan(total_score)),
        g AS (SELECT s.*, keep_percent, count(*) OVER (PARTITION BY dimension) AS n,
                     count(*) OVER (PARTITION BY dimension ORDER BY total_score DESC RANGE UNBOUNDED PRECEDING) AS upto
              FROM s JOIN keep_targets USING (dimension)),
        c AS (SELECT dimension, max(total_score) AS cutoff FROM g WHERE upto * 100 >= n * keep_percent GROUP BY dimension)"""
    # similar texts by prefix filtering: two sets of similarity t share one of the n - ceil(t n) + 1 rarest members of each
    least, similar = _SETTING.format("similarity_min_chars"), _SETTING.format("similarity_min")
    bare = lambda c: rf"regexp_replace({c}, '[\t-\r\x1C-\x20\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', '', 'g')"
    pairs_sql = f"""
        WITH RECURSIVE records AS (SELECT DISTINCT 'qa' AS kind, qa_id AS id, {bare('assistant')} AS t FROM qa_instructions_robust UNION SELECT DISTINCT 'segment', segment_id, {bare('content')} FROM segmented_content),
        texts AS (SELECT kind, t, row_number() OVER () AS n, list_distinct(list_transform(range(1, length(t) - 3), lambda i: substr(t, i, 5))) AS s FROM (SELECT DISTINCT kind, t FROM records WHERE id IS NOT NULL AND length(t) >= {least})),
        parts AS (SELECT kind, n, len(s) AS size, unnest(s) AS g FROM texts), counted AS (SELECT *, count(*) OVER (PARTITION BY kind, g) AS f FROM parts),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY f, g) AS r FROM counted WHERE true), prefix AS (SELECT * FROM ranked WHERE f > 1 AND r <= size - ceil({similar} * size) + 1),
        candidates AS (SELECT DISTINCT x.n AS a, y.n AS b FROM prefix x JOIN prefix y ON x.kind = y.kind AND x.g = y.g AND x.n < y.n AND least(x.size, y.size) >= {similar} * greatest(x.size, y.size)),
        alike AS (SELECT a, b FROM (SELECT a, b, len(list_intersect(x.s, y.s)) AS common, len(x.s) + len(y.s) AS total FROM candidates JOIN texts x ON x.n = a JOIN texts y ON y.n = b) WHERE common / (total - common) >= {similar}),
        who AS (SELECT DISTINCT r.kind, id::BIGINT AS id, n FROM records r JOIN texts USING (kind, t)),
        found AS (SELECT x.kind, least(x.id, y.id) AS id_a, greatest(x.id, y.id) AS id_b FROM (SELECT a, b FROM alike UNION ALL SELECT n, n FROM texts) JOIN who x ON x.n = a JOIN who y ON y.n = b AND y.id <> x.id)"""
    return {
        "p1_found": pairs_sql + " SELECT DISTINCT kind, id_a, id_b FROM found",
        "p1_groups": pairs_sql
        + """, edges AS (SELECT kind, id_a AS a, id_b AS b FROM found UNION SELECT kind, id_b, id_a FROM found), reach AS (SELECT kind, a AS id, a AS root FROM edges UNION SELECT r.kind, r.id, e.b FROM reach r JOIN edges e ON e.kind = r.kind AND e.a = r.root)
            SELECT kind, id, min(root) AS group_id FROM reach GROUP BY kind, id""",
        "p5_report": """
            SELECT split_name, target_share, CAST(round(target_share * n) AS BIGINT) AS records, CAST(round(target_share * n) AS BIGINT) / n AS share
            FROM split_targets, (SELECT count(*) AS n FROM qa_instructions_robust)""",
        "p2_found": cells + " SELECT dimension, difficulty FROM c WHERE available < wanted",
        "p3_found": rf"""
            SELECT DISTINCT segment_id, CASE WHEN list_max(list_transform(string_split_regex(content, '[^\p{{L}}\p{{N}}]'), lambda x: length(x))) > {limit} THEN 'forced' ELSE 'natural' END AS cut
            FROM segmented_content WHERE length(content) > {limit}""",
        "p4_found": scored + " SELECT DISTINCT qa_id FROM g JOIN c USING (dimension) WHERE total_score >= cutoff",
        "p4_cutoffs": scored
        + """ SELECT dimension, keep_percent, count(*) AS records, CAST((count(*) * keep_percent + 99) // 100 AS BIGINT) AS wanted, cutoff, count(*) FILTER (WHERE total_score >= cutoff) AS kept
              FROM g JOIN c USING (dimension) GROUP BY dimension, keep_percent, cutoff""",
        "p5_found": """
            WITH RECURSIVE e AS (SELECT segment_id AS a, linked_segment_id AS b FROM segment_links WHERE segment_id <> linked_segment_id
                                 UNION SELECT linked_segment_id, segment_id FROM segment_links WHERE segment_id <> linked_segment_id),
            r AS (SELECT a AS node, a AS reach FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reach),
            g AS (SELECT node, min(reach) AS group_id FROM r GROUP BY node),
            q AS (SELECT DISTINCT segment_id, group_id FROM qa_instructions_robust JOIN g ON node = segment_id)
            SELECT segment_id, group_id FROM (SELECT *, count(*) OVER (PARTITION BY group_id) AS n FROM q) WHERE n > 1""",
    }
