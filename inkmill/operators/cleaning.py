"""CL*, UR*: structure-aware cleaning of documents.

All of it is row-local; only the query of marked sentences (deduplicated_sentences) is a window over them.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions import rules
from inkmill.functions.text import contains_any, final_formatting, found, remove_addresses, strip, sub

LINE = "struct<kind:string,line:string,out:string>"


def _classified(line: Column) -> Column:
    """Kind and tagged form of one stripped line: title before figure before list item."""
    title, item = found(line, "|".join(rules.TITLE_PATTERNS)), found(line, "|".join(rules.LIST_PATTERNS))
    caption = F.coalesce(*[F.when(line.contains(w), F.nullif(F.regexp_extract(line, "(?Ud)" + p, 1), F.lit(""))) for w, p in zip(rules.FIGURE_WORDS, rules.FIGURE_PATTERNS)])

    def row(kind: str, text: Column, before: str, after: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("line"), F.concat(F.lit(before), text, F.lit(after)).alias("out"))

    return (
        F.when(line == "", row("blank", line, "", ""))
        .when(title, row("title", line, "\n<标题>", "</标题>\n"))
        .when(caption.isNotNull(), row("figure", caption, "\n<图表>", "</图表>\n"))
        .when(item, row("list", line, "<列表项>", "</列表项>"))
        .otherwise(row("text", line, "", ""))
    )


def line_structure(text: Column) -> Column:
    """CL1-4: array of (kind, line, out) of the text's lines; null for null."""
    return F.transform(F.transform(F.split(text, "\n", -1), strip), _classified)


def lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row a line: id, line_no, kind, line, out."""
    return df.select(id_col, F.posexplode(line_structure(F.col(text_col))).alias("line_no", "_l")).select(id_col, "line_no", "_l.*")


def identify_structure(df: DataFrame, text_col: str) -> DataFrame:
    """CL1-5: the text with tags, and the arrays titles, figures, list_items."""
    tagged = df.withColumn("_lines", line_structure(F.col(text_col)))
    of = lambda kind: F.transform(F.filter("_lines", lambda x: x["kind"] == kind), lambda x: x["line"])
    out = tagged.withColumn(text_col, F.array_join(F.transform("_lines", lambda x: x["out"]), "\n"))
    return out.withColumns({"titles": of("title"), "figures": of("figure"), "list_items": of("list")}).drop("_lines")


def _plan(terminology) -> Column:
    """The dictionary as a literal array: per term the standard, its definition pattern and its variants with patterns."""
    word = lambda v: rf"(?Ud)\b{re.escape(v)}\b"
    terms = []
    for standard, variants in terminology:
        forms = [F.struct(F.lit(v).alias("word"), F.lit(word(v)).alias("whole"), F.lit(word(v) + r"(?![^(（]*[)）])").alias("outside")) for v in variants]
        # all since the last opening bracket; anchored there, so that texts without brackets cost one pass
        definition = rf"(?Ud)(?:^|[(（])([^(（]*+)[（(]({standard}|{'|'.join(variants)})[)）]"
        terms.append(F.struct(F.lit(standard).alias("standard"), F.lit(definition).alias("definition"), F.array(*forms).alias("forms")))
    return F.array(*terms)


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), 0)


def _term_step(acc: Column, term: Column) -> Column:
    """CL6-8 for one term: count variants as whole words, find an inline definition, rewrite undefined variants.

    They become the abbreviation, or what it stands for (all since the last bracket) if it has more than five characters."""
    text = acc["text"]
    counted = F.aggregate(term["forms"], F.lit(0), lambda n, f: n + F.when(text.contains(f["word"]), F.regexp_count(text, f["whole"])).otherwise(0))
    group = lambda i: F.call_function("regexp_extract", text, term["definition"], F.lit(i))
    facts = F.struct(counted.alias("n"), strip(group(1)).alias("term"), strip(group(2)).alias("abbr"))

    def apply(f: Column) -> Column:
        to = F.when(F.length(f["abbr"]) <= 5, f["abbr"]).otherwise(f["term"])
        quoted = F.replace(F.replace(to, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
        defined = f["abbr"] != ""
        rewrite = lambda t, v: F.when((f["term"] != v["word"]) & (f["abbr"] != v["word"]) & t.contains(v["word"]), F.regexp_replace(t, v["outside"], quoted)).otherwise(t)
        n = F.when(f["n"] > 0, f["n"]).when(defined, F.lit(1)).otherwise(F.lit(0))
        entry = F.struct(term["standard"].alias("key"), n.alias("value"))
        return F.struct(F.when(defined, F.aggregate(term["forms"], text, rewrite)).otherwise(text).alias("text"), F.when(n > 0, F.array_append(acc["counts"], entry)).otherwise(acc["counts"]).alias("counts"))

    return _let(facts, apply)


def _counted(text: Column, terminology) -> Column:
    """CL6 alone, for texts that define nothing.  Literal patterns, compiled once a task; the lookahead only makes them fail early."""
    counts = []
    for standard, variants in terminology:
        each = [F.when(text.contains(v), F.regexp_count(text, F.lit(rf"(?Ud)(?={re.escape(v)})\b{re.escape(v)}\b"))).otherwise(0) for v in variants]
        counts.append(F.struct(F.lit(standard).alias("key"), reduce(lambda x, y: x + y, each, F.lit(0)).alias("value")))
    return F.filter(F.array(*counts), lambda x: x["value"] > 0)


def standardize_terminology(df: DataFrame, text_col: str, terminology=rules.TERMINOLOGY) -> DataFrame:
    """CL6-8: variants rewritten to the abbreviation that the text defines, or to its long form; map terms of counts by standard term.

    Texts with a definition of any term go through one fold over the dictionary, a fixed list at plan time; the others
    are rewritten nowhere, so that their variants are only counted.
    """
    t = F.col(text_col)
    start = F.struct(t.alias("text"), F.array().cast("array<struct<key:string,value:int>>").alias("counts"))
    any_name = "|".join(n for s, v in terminology for n in (s, *v))
    defines = (t.contains("(") | t.contains("（")) & found(t, rf"[(（](?:{any_name})[)）]")
    plain = F.struct(t.alias("text"), _counted(t, terminology).alias("counts"))
    out = df.withColumn("_acc", F.when(defines, F.aggregate(_plan(terminology), start, _term_step)).otherwise(plain))
    return out.withColumn(text_col, F.col("_acc.text")).withColumn("terms", F.map_from_entries("_acc.counts")).drop("_acc")


def term_counts(df: DataFrame, id_col: str, text_col: str, terms: DataFrame) -> DataFrame:
    """CL6 for a dictionary table (standard, variants): id, standard, n of occurrences of the variants as substrings.

    The dictionary is joined to documents by containment; it is collected into a literal array and must stay small.
    """
    rows = [(r.standard, v) for r in terms.select("standard", "variants").orderBy("standard").collect() for v in (r.variants or [])]
    pairs = F.array(*[F.struct(F.lit(s).alias("standard"), F.lit(v).alias("variant")) for s, v in rows])
    t = F.col(text_col)
    counted = F.transform(pairs, lambda p: F.struct(p["standard"].alias("standard"), ((F.length(t) - F.length(F.replace(t, p["variant"], F.lit("")))) / F.length(p["variant"])).cast("long").alias("n")))
    return df.select(id_col, F.inline(F.filter(counted, lambda x: x["n"] > 0))).groupBy(id_col, "standard").agg(F.sum("n").alias("n"))


def sentence_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """CL9-10: id, para_idx, sent_idx, sentence."""
    paragraphs = df.select(id_col, F.posexplode(F.split(text_col, r"(?Ud)\n\s*\n", -1)).alias("para_idx", "_p"))
    parts = F.filter(F.transform(F.split("_p", r"[。！？\.!?]", -1), strip), lambda s: s != "")
    return paragraphs.select(id_col, "para_idx", F.posexplode(parts).alias("sent_idx", "sentence"))


def deduplicated_sentences(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """CL11: sentence_rows with ``dup``: over ten characters and said before in the document, letter case aside."""
    rows = sentence_rows(df, id_col, text_col)
    w = Window.partitionBy(id_col, F.lower("sentence")).orderBy("para_idx", "sent_idx")
    return rows.withColumn("dup", (F.length("sentence") > 10) & (F.row_number().over(w) > 1))


def remove_redundant(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """CL11-13: df with repeated sentences removed and ``redundant``, their number; other columns kept.

    Row-local: a document's sentences are compared by sorting them, so neither texts nor sentences are shuffled.
    """
    paragraphs = F.split(text_col, r"(?Ud)\n\s*\n", -1)
    parts = lambda p: F.filter(F.transform(F.split(p, r"[。！？\.!?]", -1), strip), lambda s: s != "")
    sentences = F.flatten(F.transform(paragraphs, lambda p, i: F.transform(parts(p), lambda s: F.struct(i.alias("para"), s.alias("s")))))
    out = df.withColumn("_said", sentences)
    out = out.withColumn("_keys", F.transform("_said", lambda x: F.lower(x["s"])))

    def first(ranked: Column) -> Column:
        again = lambda x, i: (i > 0) & F.coalesce(F.get(ranked, i - 1)["k"] == x["k"], F.lit(False)) & (F.length(F.get("_said", x["i"])["s"]) > 10)
        return F.sort_array(F.transform(ranked, lambda x, i: F.struct(x["i"].alias("i"), again(x, i).alias("dup"))))

    flags = _let(F.sort_array(F.transform("_keys", lambda k, i: F.struct(k.alias("k"), i.alias("i")))), first)
    kept = _let(flags, lambda f: F.filter("_said", lambda x, i: ~F.get(f, i)["dup"]))
    out = out.withColumn("_kept", F.when(F.size(F.array_distinct("_keys")) < F.size("_keys"), kept).otherwise(F.col("_said")))
    gap = lambda x, i: F.when((i > 0) & (F.get("_kept", i - 1)["para"] != x["para"]), F.lit("\n\n")).otherwise(F.lit(""))
    text = F.array_join(F.transform("_kept", lambda x, i: F.concat(gap(x, i), x["s"], F.lit("。"))), "")
    count = F.when(F.col(text_col).isNotNull(), F.size("_said") - F.size("_kept")).otherwise(0).cast("long")
    return out.withColumns({"redundant": count, text_col: F.when(F.col(text_col).isNotNull(), text)}).drop("_said", "_keys", "_kept")


def associate_figures(text: Column) -> Column:
    """CL14: the text after a figure tag up to the next tag is marked as its description."""
    return F.when(~text.contains("<图表>"), text).otherwise(F.regexp_replace(text, r"(?Ud)<图表>([^\n]*?)</图表>\s*([^<\s][^<]*?)\s*(?=<|\z)", "<图表>$1</图表>\n<图表说明>$2</图表说明>"))


def list_regions(text: Column) -> Column:
    """CL15: two or more list items in a row become a region; possessive, so that long lists don't exhaust the stack."""
    return F.when(~text.contains("<列表项>"), text).otherwise(F.regexp_replace(text, r"(?Ud)((?:<列表项>[^\n<]*+</列表项>\s*+){2,}+)", "\n<列表区域>\n$1\n</列表区域>\n"))


def tag_definitions(text: Column, terms: Column, terminology=rules.TERMINOLOGY) -> Column:
    """CL16: definition sentences that name a counted term are wrapped in a tag with the first such term.

    A definition lies within a run without full stops and line ends, so that only runs with a definition word are searched.
    """
    pattern = rf"(?Ud)([^。\n]{{0,50}}({'|'.join(rules.DEFINITION_WORDS)})[^。\n]{{10,200}})"
    named = [(s, F.map_contains_key(terms, F.lit(s)), (s, *v)) for s, v in terminology]

    def tag(acc: Column, d: Column) -> Column:
        term = F.coalesce(*[F.when(there & contains_any(d, names), F.lit(s)) for s, there, names in named])
        return F.when(term.isNotNull(), F.replace(acc, d, F.concat(F.lit('<技术定义 term="'), term, F.lit('">'), d, F.lit("</技术定义>")))).otherwise(acc)

    runs = F.filter(F.split(text, "[。\n]", -1), lambda r: contains_any(r, rules.DEFINITION_WORDS))
    definitions = F.flatten(F.transform(runs, lambda r: F.regexp_extract_all(r, F.lit(pattern), F.lit(1))))
    return F.when((F.size(terms) > 0) & contains_any(text, rules.DEFINITION_WORDS), F.aggregate(definitions, text, tag)).otherwise(text)


def clean_documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """CL0: the eight steps in order.  Adds titles, figures, list_items, terms, redundant, removed_references.

    Ids must be unique; null texts stay null.
    """
    t = F.col(text_col)
    out = standardize_terminology(identify_structure(df, text_col), text_col)
    out = remove_redundant(out, id_col, text_col)
    out = out.withColumn(text_col, list_regions(associate_figures(t)))
    out = out.withColumn(text_col, tag_definitions(t, F.col("terms")))
    out = remove_addresses(out, text_col, "removed_references")
    return out.withColumn(text_col, final_formatting(t))


def cleaning_report(cleaned: DataFrame, input_file: str, output_file: str) -> DataFrame:
    """IO15: a report a document, as one struct column beside the others."""
    stats = F.struct(
        F.size("titles").alias("identified_titles"), F.size("figures").alias("identified_figures"), F.size("list_items").alias("list_sections"), F.col("removed_references"), F.col("terms").alias("standardized_terms")
    )
    return cleaned.withColumn("report", F.struct(F.lit(input_file).alias("input_file"), F.lit(output_file).alias("output_file"), stats.alias("statistics")))
