"""Registry of the engine's queries over the pipeline's tables; their SQL is in oracles.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions import text, topics
from inkmill.operators import cleaning, generation, quality, repair, segmenting, selection
from inkmill.plans import pipeline
from inkmill.sources import io


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _docs(spark, d):
    return _table(spark, d, "documents")


def _qa(spark, d):
    return _table(spark, d, "qa_instructions_robust")


def _segments(spark, d):
    """Segments, repeated deliveries once."""
    return _table(spark, d, "segmented_content").select("segment_id", "content").dropDuplicates(["segment_id"])


def clean_text_gen(spark, d):
    return _docs(spark, d).select("doc_id", text.clean_for_generation(F.col("text")).alias("cleaned"))


def clean_text_fix(spark, d):
    return _qa(spark, d).select("qa_id", text.clean_for_repair(F.col("user")).alias("cleaned"))


def token_count(spark, d):
    return _docs(spark, d).select("doc_id", text.tokens(F.coalesce("text", F.lit(""))).cast("long").alias("tokens"))


def line_structure(spark, d):
    return cleaning.lines(_docs(spark, d), "doc_id", "text")


def line_kind_counts(spark, d):
    return line_structure(spark, d).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def terminology_counts(spark, d):
    return cleaning.term_counts(_docs(spark, d), "doc_id", "text", _table(spark, d, "terminology"))


def terminology_standardize(spark, d):
    return cleaning.standardize_terminology(_docs(spark, d).select("doc_id", "text"), "text")


def sentence_split(spark, d):
    return cleaning.sentence_rows(_docs(spark, d), "doc_id", "text")


def sentence_dedup(spark, d):
    return cleaning.deduplicated_sentences(_docs(spark, d), "doc_id", "text")


def remove_redundant(spark, d):
    return cleaning.remove_redundant(_docs(spark, d).select("doc_id", "text"), "doc_id", "text")


def strip_tags(spark, d):
    return _docs(spark, d).select("doc_id", text.strip_tags(F.col("text")).alias("stripped"))


def final_formatting(spark, d):
    return _docs(spark, d).select("doc_id", text.final_formatting(F.col("text")).alias("formatted"))


def _tagged(spark, d):
    return cleaning.identify_structure(_docs(spark, d).select("doc_id", "text"), "text")


def figure_association(spark, d):
    return _tagged(spark, d).select("doc_id", cleaning.associate_figures(F.col("text")).alias("text"))


def list_regions(spark, d):
    return _tagged(spark, d).select("doc_id", cleaning.list_regions(F.col("text")).alias("text"))


def concept_tags(spark, d):
    t = cleaning.standardize_terminology(_docs(spark, d).select("doc_id", "text"), "text")
    return t.select("doc_id", cleaning.tag_definitions(F.col("text"), F.col("terms")).alias("text"))


def url_remove(spark, d):
    return text.remove_addresses(_docs(spark, d).select("doc_id", "text"), "text")


def url_remove_basic(spark, d):
    """UR1-7 alone, the rules without lookaround."""
    return text.remove_addresses(_docs(spark, d).select("doc_id", "text"), "text", patterns=text.rules.URL_ROUNDS[:7], names=(), tidy=False)


def clean_document(spark, d):
    return cleaning.clean_documents(_docs(spark, d).select("doc_id", "text"), "doc_id", "text")


def cleaning_report(spark, d):
    return cleaning.cleaning_report(clean_document(spark, d), "processed_content.txt", "enhanced_content.txt").select("doc_id", F.to_json("report").alias("report"))


def cleaning_digest(spark, d):
    return pipeline.cleaning_digest(clean_document(spark, d), "doc_id")


def segments(spark, d):
    return segmenting.segments(_docs(spark, d), "doc_id", "text")


def segment_filter(spark, d):
    """SG3-5 over the lines of documents in place of chunks."""
    return segmenting.long_enough(_docs(spark, d).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("segment_no", "content")))


def topic_extract(spark, d):
    return _segments(spark, d).select("segment_id", topics.extract(F.col("content")).alias("topic"))


def topic_valid(spark, d):
    return _qa(spark, d).select("qa_id", topics.is_valid(F.col("topic")).alias("valid"))


def topic_relation(spark, d):
    return _qa(spark, d).where("topic is not null and assistant is not null").select("qa_id", topics.related(F.col("topic"), F.col("assistant")).alias("topic"))


def answer_sentences(spark, d):
    s = text.sentences(text.clean_for_generation(F.col("content")))
    return _segments(spark, d).select("segment_id", F.posexplode(s).alias("sent_idx", "sentence"))


def answer_greedy(spark, d):
    return _segments(spark, d).select("segment_id", generation.quality_answer(F.col("content")).alias("answer"))


def template_expand(spark, d):
    segs = _segments(spark, d).where("content is not null")
    return generation.expand_questions(segs).select("segment_id", "dimension", "difficulty", "topic", "user")


def question_sample(spark, d):
    segs = _segments(spark, d).where("content is not null")
    return generation.sample_questions(segs, ["segment_id"]).select("segment_id", "dimension", "difficulty", "topic", "user", "assistant")


def topic_mode(spark, d):
    return generation.main_topics(_qa(spark, d), "segment_id")


def topic_consistency(spark, d):
    qa = _qa(spark, d).select("qa_id", "segment_id", "topic", "assistant").where("segment_id is not null")
    return generation.consistent_topics(qa, "segment_id", F.col("assistant")).select("qa_id", "topic")


def validate_pairs(spark, d):
    q, a = F.col("user"), F.col("assistant")
    return _qa(spark, d).select("qa_id", generation.needs_fix(q, a).alias("needs_fix"), generation.is_sound(q, a).alias("sound"))


def repair_lookup_join(spark, d):
    qa = _qa(spark, d).select("qa_id", "user", "assistant", "topic", "dimension", "segment_id")
    return generation.repair_pairs(qa, _segments(spark, d).where("content is not null"), "segment_id", "content")


def pair_statistics(spark, d):
    return generation.statistics(_qa(spark, d), _segments(spark, d), "segment_id")


def fix_question(spark, d):
    return _qa(spark, d).select("qa_id", repair.fix_question(F.col("user")).alias("user"))


def fix_answer(spark, d):
    return _qa(spark, d).select("qa_id", repair.fix_answer(F.col("assistant")).alias("assistant"))


def fix_pairs(spark, d):
    return repair.fix_pairs(_qa(spark, d).select("qa_id", "user", "assistant"))


def fix_chat(spark, d):
    """The repaired chat records, a row a turn."""
    fixed = repair.fix_chat(_table(spark, d, "qa_chat").select("qa_id", "conversations"))
    return fixed.select("qa_id", F.posexplode("conversations").alias("turn_no", "_t")).select("qa_id", "turn_no", "_t.role", "_t.content")


def validate_fixed(spark, d):
    fixed = repair.fix_pairs(_qa(spark, d).select("user", "assistant"))
    return repair.validation(fixed, F.col("user"), F.col("assistant"))


def validate_chat(spark, d):
    chat = _table(spark, d, "qa_chat")
    return repair.validation(chat, repair.first_turn(F.col("conversations"), "user"), repair.first_turn(F.col("conversations"), "assistant"))


def _files(spark, d):
    """The flat and the chat records as two files, in order."""
    keep = ["file_ord", "qa_id", "question", "answer", "topic", "dimension", "difficulty"]
    flat = _qa(spark, d).select(F.lit(1).alias("file_ord"), "qa_id", F.col("user").alias("question"), F.col("assistant").alias("answer"), "topic", "dimension", "difficulty")
    chat = quality.chat_to_pairs(_table(spark, d, "qa_chat").withColumn("file_ord", F.lit(2)))
    return quality.with_duplicates(flat.unionByName(chat.select(*keep)), ["file_ord", "qa_id"])


def duplicates(spark, d):
    return _files(spark, d).select("file_ord", "qa_id", "dup_question", "dup_answer")


def _scored(spark, d):
    return quality.evaluate(_files(spark, d))


def _score(name):
    return lambda spark, d: _scored(spark, d).select("file_ord", "qa_id", F.col(name).cast("long").alias(name))


def keyword_set(spark, d):
    return _qa(spark, d).select("qa_id", F.array_join(F.array_sort(quality.keywords(F.coalesce("user", F.lit("")))), "|").alias("keywords"))


def evaluate_pairs(spark, d):
    return _scored(spark, d).select("file_ord", "qa_id", "total_score", F.size("issues").cast("long").alias("n_issues"), F.array_join("issues", "; ").alias("issues"))


def quality_report(spark, d):
    return quality.report(_scored(spark, d), ["file_ord"])


def report_digest(spark, d):
    return pipeline.report_digest(quality_report(spark, d), "file_ord")


def report_json(spark, d):
    """The report of each file in its nested shape, as JSON."""
    return quality_report(spark, d).select("file_ord", io.report_lines(F.concat(F.lit("file"), F.col("file_ord").cast("string")), quality.COUNTERS).alias("report"))


def issue_counts(spark, d):
    return quality.cumulative(quality_report(spark, d), "file_ord").select("file_ord", *quality.COUNTERS)


def select_threshold(spark, d):
    return selection.above(_scored(spark, d)).select("file_ord", "qa_id", "total_score")


def _slim_scored(spark, d):
    """What the selection needs of the scored records, written once: it is read by several branches."""
    return pipeline.materialized(_scored(spark, d).select("file_ord", "qa_id", "total_score", "dimension", "difficulty"))


def select_balanced(spark, d):
    return selection.balanced(_slim_scored(spark, d), ["file_ord", "qa_id"]).select("file_ord", "qa_id", "total_score", "extra")


def final_top200(spark, d):
    best = selection.balanced(_slim_scored(spark, d), ["file_ord", "qa_id"])
    return selection.final_list(best, ["file_ord", "qa_id"]).select("file_ord", "qa_id", "total_score")


def chat_jsonl(spark, d):
    qa = _qa(spark, d)
    return qa.select("qa_id", io.chat_lines(qa).alias("line"))


def flat_json(spark, d):
    qa = _qa(spark, d)
    return qa.select("qa_id", io.flat_lines(qa, ("system", "user", "assistant", "topic", "dimension", "difficulty", "segment_id")).alias("line"))


def page_join(spark, d):
    """Documents cut into pages at their page marks, and joined again with new numbers."""
    pages = _docs(spark, d).where("text is not null").select("doc_id", F.posexplode(F.split("text", "(?Ud)" + text.rules.PAGE_MARK, -1)).alias("_no", "text"))
    return io.join_pages(pages.select("doc_id", (F.col("_no") + 1).alias("page_no"), "text"))


def topic_top10(spark, d):
    return pipeline.top_topics(_qa(spark, d))


def dimension_dist(spark, d):
    return pipeline.dimension_distribution(_qa(spark, d))


def _stages(spark, d):
    return pipeline.run(_docs(spark, d))


def stage_counts(spark, d):
    return pipeline.stage_counts(_stages(spark, d))


def full_pipeline(spark, d):
    final = _stages(spark, d)["final"]
    return final.select("doc_id", "segment_no", "dimension", "difficulty", "topic", "question", "answer", "total_score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {n: f for n, f in globals().items() if callable(f) and not n.startswith("_") and getattr(f, "__module__", "") == __name__ and f not in (queries, oracle_sql)}
    return named | {n: _score(n) for n in ("question_score", "answer_score", "metadata_score", "relevance_score")}


def oracle_sql() -> dict[str, str]:
    from inkmill import oracles

    return oracles.build()
