"""Text functions as Catalyst columns.  Patterns use (?Ud): Unicode classes, and only \\n ends a line."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions import rules


def sub(c: Column, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(c, "(?Ud)" + pattern, to)


def found(c: Column, pattern: str) -> Column:
    return c.rlike("(?Ud)" + pattern)


def strip(c: Column) -> Column:
    return sub(c, r"^\s+|\s+$")


def let(value: Column, body) -> Column:
    """body of value, which is evaluated once however often body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def sub_where(c: Column, sign: str, pattern: str, to: str = "") -> Column:
    """sub, but only texts with the sign, which every match needs, are searched."""
    return let(c, lambda x: F.when(x.contains(sign), sub(x, pattern, to)).otherwise(x))


def single_spaced(c: Column) -> Column:
    """Runs of white space as one space each; single spaces are no match, so that they cost nothing."""
    return sub(c, r" \s+|[^\S ]\s*", " ")


def contains_any(c: Column, words) -> Column:
    return reduce(lambda a, b: a | b, (c.contains(w) for w in words))


def tokens(c: Column) -> Column:
    """Length in tokens: a third of the characters, the default where no vocabulary is given."""
    return F.floor(F.length(c) / 3).cast("int")


def clean_for_generation(c: Column) -> Column:
    """GC1: control characters and page marks away, white space single, none after end marks; null gives ''."""
    c = sub(F.coalesce(c, F.lit("")), rules.CONTROL)
    c = single_spaced(sub_where(c, "===", rules.PAGE_MARK))
    return strip(sub(c, r"([。！？!?;；])\s+", "$1"))


def clean_for_repair(c: Column) -> Column:
    """FC1: like GC1, with book marks as quotes and a question mark forced at the end; null gives ''."""
    c = sub(F.coalesce(c, F.lit("")), rules.CONTROL)
    c = F.translate(sub(c, r"[《》]\z"), "《》", '""')
    ends = found(strip(c), r"[？?!！]\z") | (strip(c) == "")
    c = F.when(ends, c).when(found(c, r"[^\w]\z"), F.concat(F.substring(c, F.lit(1), F.length(c) - 1), F.lit("？"))).otherwise(F.concat(c, F.lit("？")))
    c = sub(sub(c, r"\s+", " "), rules.PAGE_MARK)
    return strip(sub(sub(c, r"([。！？!?;；])\s+", "$1"), r'"{2,}', '"'))


def sentences(c: Column) -> Column:
    """AN2: sentences with their end mark; a tail without one is dropped, as are blank ones."""
    pieces = F.split(c, r"(?<=[。！？!?;；])")
    return F.filter(F.transform(F.filter(pieces, lambda s: found(s, r"[。！？!?;；]\z")), strip), lambda s: s != "")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]+>", "")


def final_formatting(c: Column) -> Column:
    """CL17-20: tags away, blank lines, space after CJK marks, single white space."""
    c = let(c, lambda x: F.when(x.contains("<"), strip_tags(x)).otherwise(x))
    c = sub_where(c, "\n\n\n", r"\n{3,}", "\n\n")
    c = sub_where(c, "\n", r"([。！？\.!?])\s*\n([^\s])", "$1\n\n$2")
    return sub_where(single_spaced(sub(c, r"([。，；：！？])([^\s])", "$1 $2")), "\n", r" +(?=\n)")


def words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"(?Ud)\w+"), F.lit(0))


def remove_addresses(df: DataFrame, text_col: str, fired_col: str = "fired", patterns=rules.URL_ROUNDS, names=rules.SITE_NAMES, tidy: bool = True) -> DataFrame:
    """UR1-18: df with the text without web addresses and ``fired``, how many rules shortened it; null for null.

    One select whose columns build on each other (lateral aliases), so that each pattern is a literal, compiled once a task;
    texts without what a pattern needs (URL_SIGNS) are not searched for it.  Rules only take away, so bytes tell of shorter texts.
    """
    signs = dict(zip(rules.URL_ROUNDS, rules.URL_SIGNS, strict=True))
    steps, last = [F.col(text_col).alias("_address0")], "_address0"
    for i, rule in enumerate([*patterns, *names], 1):
        cut = F.regexp_replace(last, "(?Ud)" + rule, "") if i <= len(patterns) else F.replace(F.col(last), F.lit(rule), F.lit(""))
        needed = signs.get(rule, ()) if i <= len(patterns) else ((rule,),)
        if needed:
            cut = F.when(reduce(lambda x, y: x & y, (contains_any(F.col(last), words) for words in needed)), cut).otherwise(F.col(last))
        last = f"_address{i}"
        steps.append(cut.alias(last))
    size = lambda i: F.octet_length(F.col(f"_address{i}"))
    fired = reduce(lambda x, y: x + y, ((size(i) < size(i - 1)).cast("int") for i in range(1, len(steps))), F.lit(0))
    c = F.col(last)
    if tidy:
        marked = lambda x: sub(sub(x, r"\s+([,.?!;:])", "$1"), r"([,.?!;:])([,.?!;:])", "$1")
        c = sub(F.when(contains_any(c, ",.?!;:"), marked(c)).otherwise(c), r"\s{2,}", " ")
    kept = [F.col(f"`{x}`") for x in df.columns if x not in (text_col, fired_col)]
    out = df.select(*kept, *steps, c.alias("_addresses_out"), fired.alias("_addresses_fired"))
    placed = [F.col("_addresses_out").alias(text_col) if x == text_col else F.col(f"`{x}`") for x in df.columns if x != fired_col]
    return out.select(*placed, F.col("_addresses_fired").alias(fired_col))
