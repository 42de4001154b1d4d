"""TP*: the topic of a text, as one cascade of columns; the first rule that hits wins."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.functions import rules
from inkmill.functions.text import clean_for_generation, contains_any, strip

AUTONOMOUS, WAREHOUSE, LOGISTICS, CHAIN, DEFAULT = "自动驾驶技术", "仓库管理技术", "物流技术", "供应链技术", "供应链执行技术"


def is_valid(t: Column) -> Column:
    """TP9; null is invalid."""
    stops, parts = "|".join(rules.TOPIC_STOPS), "|".join(map(re.escape, rules.TOPIC_BAD_PARTS))
    bad = (F.length(t) < 3) | t.rlike(rf"(?Ud){parts}|^(?:{stops})|(?:{stops})\z|^[\d\s.,;:]+\z|^的\w{{1,3}}\z") | t.isin(*rules.TOPIC_GENERIC)
    return F.coalesce(~bad, F.lit(False))


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), 0)


def _group(c: Column, pattern: str) -> Column:
    return strip(F.regexp_extract(c, "(?Ud)" + pattern, 1))


def extract(text: Column, cleaned: Column | None = None) -> Column:
    """TP0-TP7 over the cleaned text (a column of its own where given); an empty or null text gives the chain topic."""
    signs = ("是指", "指的是", "被定义为", *(m + w for m in ":：" for w in ("技术定义", "原理")))

    def cascade(c: Column) -> Column:
        # a cheap test for the fixed part of each pattern comes before the pattern itself
        header = F.when(contains_any(c, (")技术", "）技术")) & c.rlike("[)）]技术[:：]"), _group(c, r"([\w\s]{2,20})[（(]([^)）]+)[)）]技术[:：]"))
        steps = [_let(header, lambda h: F.when((F.length(h) > 2) & is_valid(F.concat(h, F.lit("技术"))), F.concat(h, F.lit("技术"))))]
        for term in rules.KNOWN_TERMS:
            there = contains_any(c, signs) if re.search("[a-zA-Z]", term) else c.contains(term)  # the sign, as letters match in any case
            said = there & c.rlike(f"(?Uid){term}([：:](技术定义|原理|是指)|是指|指的是|被定义为)")
            often = c.contains(term) & ((F.length(c) - F.length(F.replace(c, F.lit(term), F.lit("")))) >= 3 * len(term))
            steps.append(F.when(said | often if len(term) > 4 else said, F.lit(term)))
        for pattern, sign, parts in zip(rules.TOPIC_DEFINITIONS, rules.TOPIC_DEFINITION_SIGNS, rules.TOPIC_DEFINITION_WORDS):

            def named(g: Column) -> Column:
                t = F.when(g.contains("技术"), g).otherwise(F.concat(g, F.lit("技术")))
                return F.when((F.length(g) > 3) & is_valid(t), t)

            steps.append(F.when(contains_any(c, parts) & c.rlike(sign), _let(_group(c, pattern), named)))
        head = F.substring(c, 1, 200)
        for noun in rules.TOPIC_NOUNS:
            all_found = F.regexp_extract_all(head, F.lit(rf"(?Ud)(\w{{2,15}}{noun})"), F.lit(1))
            fit = F.filter(all_found, lambda m: (F.length(m) > 4) & is_valid(m))
            # the longest, the first among equals
            longest = (F.reduce(fit, F.lit(None).cast("string"), lambda best, m: F.when(F.length(m) > F.coalesce(F.length(best), F.lit(0)), m).otherwise(best)))
            steps.append(F.when(head.contains(noun), longest))
        joined = F.when(contains_any(c, [a + b for a in "与和" for b in ("安全", "责任", "挑战", "限制", "问题")]), F.regexp_extract(c, r"(?Ud)(\w{2,15})(与|和)(安全|责任|挑战|限制|问题)", 1))
        steps.append(_let(joined, lambda j: F.when((j != "") & is_valid(F.concat(j, F.lit("技术"))), F.concat(j, F.lit("技术")))))
        auto = c.contains("自动驾驶")
        steps.append(F.when(auto & (c.contains("卡车") | c.contains("物流")), F.lit("自动驾驶卡车技术")).when(auto & (c.contains("责任归属") | c.contains("安全与责任")), F.lit(AUTONOMOUS)))
        steps.append(F.when(c.contains("仓库") | c.contains("WMS"), F.lit(WAREHOUSE)).when(c.contains("物流"), F.lit(LOGISTICS)).when(c.contains("供应链"), F.lit(CHAIN)).otherwise(F.lit(DEFAULT)))
        return F.coalesce(*steps)

    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(CHAIN)).otherwise(_let(clean_for_generation(text), cascade) if cleaned is None else cascade(cleaned))


def strong(t: Column, content: Column) -> Column:
    """TP10."""
    weak = t.endswith("的因素") | t.startswith("的") | (F.length(t) < 4)
    return F.when(weak & content.contains("自动驾驶"), F.lit(AUTONOMOUS)).when(weak & content.contains("仓库"), F.lit(WAREHOUSE)).when(weak & content.contains("供应链"), F.lit(CHAIN)).otherwise(t)


def supported(t: Column, content: Column) -> Column:
    """TP11."""
    said = F.exists(F.regexp_extract_all(t, F.lit(r"(?Ud)\w+"), F.lit(0)), lambda w: (F.length(w) > 1) & content.contains(w))
    known = F.coalesce(*[F.when(content.contains(k), F.lit(k)) for k in rules.KNOWN_TERMS])
    return F.when(said, t).otherwise(F.coalesce(F.when(F.length(t) > 2, known), F.lit(DEFAULT)))


def related(topic: Column, content: Column) -> Column:
    """TP10-11: the topic, or one that the content supports."""
    # bound twice, so that the cascade is evaluated once
    return _let(_let(topic, lambda t: strong(t, content)), lambda t: supported(t, content))
