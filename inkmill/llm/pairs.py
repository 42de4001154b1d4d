"""Problem 6: broken prompt and response pairs."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import cut_lineage, distinct_texts
from inkmill.llm.languages import Languages, fit_languages  # noqa: F401

#: Weight of the shorter n-gram in the smoothed probability that a text ends after an n-gram.
BACKOFF = 2.0
#: Smoothed probability that a line ends after the final n-gram, from which on it is taken for whole without a mark; an
#: answer of one clause often goes without a mark: there it takes evidence to flag it, a probability below this share of that after any character.
END_SHARE, CLAUSE_RATIO = 0.3, 0.25
#: Bits of the filter that keeps n-grams no answer ends in out of the counts: a broadcast of 0.5 MB, whatever the data.
FILTER_BITS = 1 << 22
FILTER_PRIME = 4_194_301

# Fixed values from here on.
#: Contents of a placeholder, without marks and in lower case.
PLACEHOLDERS = frozenset("待补充 待定 待填 待填写 待续 待更新 待完善 待录入 未填写 无 暂无 暂无内容 暂无答案 暂无数据 暂无资料 无内容 无答案 没有内容 空 空白 略 同上 tbd tba todo null none nil na nan undefined empty blank placeholder noanswer nocontent notavailable xxx".split())
#: Labels that may stand before an answer.
LABELS = ("答案", "回答", "答复", "答", "answer", "response", "a", "antwort", "回复")
#: What may stand around a repeated question, without marks: words that name a question or an answer, say who asks it, and repeat it.
LEAD_IN = regex.compile(
    r"(?:您好|你好|好的|请问|请|您|你|我们?|用户|所|想要?|希望|需要|要|问|提问|知道|了解|询问|咨询|的|是|为|以下|下面|上述|这个|该|原|关于|复述|重复|一遍|一下|如下|就是|即|内容|问题|题目|题|答案|回答|答复|回复|答|质问|回|"
    r"hello|hi|you|your|are|asked|ask|asking|want|to|know|about|whether|the|original|following|question|prompt|query|was|is|answer|response|q|a|sie|fragten|ihre|frage|lautet|war|ist|nach|antwort)*"
)
_NOUN = r"(?:(?:这|该|此|本|您|你|我|其|上述|相关|所问|个|件|类|种|些|部分|的)*(?:问题|提问|话题|内容|信息|事情|事|题目|题|点|方面|情况|细节|领域)?)"
_ADVERB = r"(?:[\s、]|但是|但|可是|不过|然而|而|因此|所以|故|目前|暂时|现在|当前|暂|恐怕|确实|实在|真的|其实|也|还|都|就|并|很?抱歉|对不起|不好意思|对此|就此|对于?|关于|至于|针对)*"
#: Before a predicate of refusal: the answerer, the question, or nobody; statements about other things have other subjects.
REFUSER = regex.compile(rf"{_ADVERB}{_NOUN}{_ADVERB}(?:我们?|本人|笔者|本?助手|作为[^，。]*)?{_ADVERB}")
INABILITY = regex.compile(r"(?:无法|不能|不便|难以|没法|没办法|不予|不方便|不宜|不可|恕不|恕难|拒绝|不会)[^，。]{0,10}?(?P<act>回答|作答|答复|回复|解答|评论|讨论|透露|告知|猜测|提供|给出|判断|协助|帮)")
IGNORANCE = regex.compile(r"帮不上忙|答不上来|答不了|无可奉告|一无所知|并?不(?:太|是很|大)?(?:清楚|知道|了解|知晓)|超出了?我|不在我的")
LACK = regex.compile(r"(?:没有|缺乏|缺少)(?P<enough>足够|充分)?[^，。]{0,6}(?:资料|信息|数据|依据)")
SELF = regex.compile(r"我|本人|笔者|助手|作为")
DECLINES_ELSE = regex.compile(
    r"(?i)^(?:(?:but|unfortunately|sadly|regrettably|however|sorry|as an? (?:\w+ ){0,3}(?:ai|assistant|model)|[,;]|at the moment|currently)\s*)*(?:i|we)\b(?:'m| am| are)?(?: \w+){0,2}? ?"
    r"(?:can(?:no|')t|can not|cannot|could not|unable|not able|not allowed|not permitted|not in a position|don't|do not|won't|will not|must decline|have to decline)\b.*?\b(?:answer|comment|help|assist|provide|discuss|information|know|say|tell|share)\b|"
    r"\bno answer can be given\b|\b(?:this|that|the|your) (?:question|request|topic|matter)\b[^.]{0,30}?\b(?:cannot|can't|can not) be (?:answered|discussed|commented)|\b(?:beyond|outside) (?:my|what i|the scope of my)\b|\bi(?:'m| am) (?:sorry|afraid)\b.*\b(?:can't|cannot|can not|unable|don't|do not)\b|"
    r"\bich (?:kann|darf|weiß)\b.*\b(?:nicht|keine)\b|\bkann ich\b.*\b(?:nicht|keine)\b.*\b(?:beantworten|helfen|sagen|geben)"
)
#: Clauses without content: greetings, apologies, thanks, the topic, the rules or the role that the answerer goes by.
COURTESY = regex.compile(
    r"(?i)\s*(?:(?:您|你)?好|hello|hi|dear user|(?:非常|很|十分|实在)?抱歉|对不起|不好意思|(?:感谢|谢谢)[^，。]*|恕我直言|说实话|坦率地说|老实说|unfortunately|sorry|i(?:'m| am) (?:sorry|afraid)|thank you.*|thanks.*|leider|tut mir leid|entschuldigung|(?:关于|对于|至于|针对|就|依照|按照|根据|作为|鉴于)[^，。]*|(?:regarding|about|concerning|as for|as an?) .*)?\s*"
)
_CONTRAST = regex.compile(r"(?i)\s*(?:但|不过|可是|然而|but\b|however\b)")
#: Letters that clauses of refusal in other languages have, and characters that Chinese ones have.
_LATIN, _NEGATION = regex.compile(r"[A-Za-z]{2}"), regex.compile(r"[无不没拒恕缺难超答]")
_QUOTED = regex.compile(r"[“\"「『][^”\"」』]*[”\"」』]")
_QUOTE = regex.compile("[“\"「『]")
_SENTENCES = regex.compile(r"[。！？!?\n]|\.(?=\s|$)")
_CLAUSES = regex.compile(r"[，,;；：:]")
_TAG = regex.compile(r"<[^<>]{0,60}>|&[a-zA-Z#0-9]{1,8};")
_RUN = regex.compile(r"[\p{L}\p{N}]+")
# Patterns with (?r) are matched from the end of a text backwards.
#: Marks that something must follow.
_OPEN = regex.compile(r"(?r)[，、,：:（(“‘《「『【\[]")
_END = regex.compile(r"(?r)(?:[。！？!?．؟।]|(?<![\s\d.])\.|(?<=\d)\.(?<!(?:^|\n)\s*\(?\d{1,3}\.))[”’」』）)\]】》\"'*_`]*")
_DOTS = regex.compile(r"(?r)(?:[\s\p{Cc}\p{Cf}\p{Z}\uFFFD]|…|\.{2,}|。{2,}|·{2,})+")
#: What may stand between the mark of the last sentence and the end: emoji and complete bracketed references.
_AFTER_MARK = regex.compile(r"(?r)(?:[\s\p{So}\p{Sk}\p{M}\u200D]|[（(\[【][^()（）\[\]【】\n]{1,30}[)）\]】])+")
_ITEM = regex.compile(r"\s*(?:[-*•●·‣▪+]|\d{1,3}[.、)）]|[(（]\d{1,3}[)）]|[①-⑳])")
_BARE_ITEM = regex.compile(r"\s*(?:[-*•●·‣▪+]|\d{1,3}[.、)）]|[(（]\d{1,3}[)）]|[①-⑳])\s*$")
#: Marks that end a clause.
CLAUSE_MARKS = "。！？!?．，,；;：:、"
_CLAUSE = regex.compile(f"[{CLAUSE_MARKS}\n]")


def _folded_form(text: str) -> str:
    return unicodedata.normalize("NFKC", text).lower()


def bare(text: str | None) -> str:
    """Letters and digits only, compatibility forms folded, lower case."""
    return "".join(_RUN.findall(_folded_form(text or "")))


def is_empty(answer: str | None) -> bool:
    """Null, blank, marks or markup only, or only a placeholder."""
    if not answer:
        return True
    most = max(map(len, PLACEHOLDERS)) + max(map(len, LABELS))
    b = ""
    for run in _RUN.finditer(_TAG.sub("", answer)):
        b += run.group()
        if len(b) > 2 * most:  # longer than any placeholder
            return False
    b = bare(b)
    return not b or b in PLACEHOLDERS or any(b.startswith(x) and (b[len(x) :] in PLACEHOLDERS or b == x) for x in LABELS)


def is_copy(question: str | None, answer: str) -> bool:
    """Nothing but the question again, once or more, give or take marks, labels and lead-in words."""
    runs = _RUN.findall(_folded_form(question)) if question else None
    if not runs:
        return False
    said = _folded_form(answer)
    if max(runs, key=len) not in said:
        return False
    q, a = "".join(runs), "".join(_RUN.findall(said))
    return q in a and all(LEAD_IN.fullmatch(x) for x in a.split(q))


def _declines(clause: str, question: str) -> bool:
    if _LATIN.search(clause) and DECLINES_ELSE.search(clause.strip()):
        return True
    if not _NEGATION.search(clause):
        return False
    for pattern in (INABILITY, IGNORANCE, LACK):
        m = pattern.search(clause)
        if not m or not REFUSER.fullmatch(clause[: m.start()]):
            continue
        own = bool(SELF.search(clause[: m.end()]))
        if pattern is LACK and not (own or m.group("enough")):
            continue
        # "it can't provide this" answers a question whether it can
        if pattern is INABILITY and not own and not clause[: m.start()].strip() and m.group("act") in question:
            continue
        return True
    return False


def is_refusal(question: str | None, answer: str) -> bool:
    """The first sentence that is more than courtesies declines to answer, and what follows in contrast to it, if anything, declines too.

    Only clauses count whose subject is the answerer, the question or nobody; what stands in quotation marks doesn't.
    """
    whole = answer.strip()
    said = whole if not _QUOTE.search(whole) or (whole[0] in "“\"「『" and whole[-1] in "”\"」』") else _QUOTED.sub("", whole)
    at = 0
    declined = False
    while at < len(said):
        stop = _SENTENCES.search(said, at)
        sentence, at = said[at : stop.start() if stop else len(said)], stop.end() if stop else len(said)
        clauses = [c for c in _CLAUSES.split(sentence) if c.strip()]
        if not clauses:
            continue
        verdicts = [_declines(c, question or "") for c in clauses]
        if declined:  # the sentence after
            return not (_CONTRAST.match(sentence) and not any(verdicts))
        if not (any(verdicts) or _declines(sentence, question or "")):
            if all(COURTESY.fullmatch(c) for c in clauses):
                continue
            return False
        declined = True
        last = max((i for i, v in enumerate(verdicts) if v), default=len(clauses))
        if any(_CONTRAST.match(c) for c in clauses[last + 1 :]):
            return False
    return declined


def _folded(text: str) -> np.ndarray:
    """Code points with digits as 0 and capitals as A."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    c[(c >= 48) & (c <= 57)] = 48
    c[(c >= 65) & (c <= 90)] = 65
    return c


def _keys(c: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that ends at each place from order - 1 on, as one number; its line style is still to be added."""
    k = np.zeros(len(c) - order + 1, np.int64) + order
    for j in range(order):
        k = k * 1_000_003 + c[j : len(c) - order + 1 + j]
    return k << 2


def _bits(keys: np.ndarray) -> np.ndarray:
    return keys % FILTER_PRIME


def tail(answer: str) -> tuple[bool, list[int]] | None:
    """(surely cut, final n-grams from none to three characters, with the line style) of an answer without an end mark; None if it has one."""
    dots = _DOTS.match(answer)
    core = answer[: dots.start()] if dots else answer
    scrap = dots is not None and bool(dots.group().strip())
    last = core[core.rfind("\n") + 1 :]
    if _BARE_ITEM.fullmatch(last):
        return True, []
    end = bool(_END.match(core)) or ((rest := _AFTER_MARK.match(core)) is not None and bool(_END.match(core[: rest.start()])))
    if not core or (end and not scrap):
        return None
    if _OPEN.match(core) or (scrap and not end):
        return True, []
    style = 1 if _ITEM.match(last) else 0 if _CLAUSE.search(core) else 2
    c = _folded(last[-3:])
    return False, [style] + [int(_keys(c[len(c) - n :], n)[0]) + style for n in range(1, len(c) + 1)]


def end_statistics(df: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """(key, uses, ends) of the n-grams of up to three characters of all texts by line style: how often they stand in a line
    of prose (0) or list (1) style, or in any (2), and how often the line ends after them, with another line after it, or, for
    2, a clause or such a line.

    What stands at the very end of a text is no evidence: it is where cuts fall, and one that recurs would pass for usual.
    Each distinct text counts once.  Only n-grams that may be
    among ``wanted.key`` are counted (a filter of FILTER_BITS bits, complete whatever its load).
    """
    spark = df.sparkSession
    hashed = F.pmod("key", F.lit(FILTER_PRIME))
    words = (
        wanted.select(hashed.alias("_b")).select(F.shiftright("_b", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_b").bitwiseAND(63).cast("int")).alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()  # at most FILTER_BITS / 64 rows
    )
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words:
        table[r.word] = r.bits
    shared = spark.sparkContext.broadcast(np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(0x110000, bool)
        marks[[ord(x) for x in CLAUSE_MARKS]] = True
        for batch in batches:
            texts = [t.rstrip() for t in batch.column(0).to_pylist() if t]
            lines = [x.rstrip() for t in texts for x in t.split("\n")]
            if not lines:
                continue
            counts = np.fromiter((t.count("\n") + 1 for t in texts), np.int64, len(texts))
            followed = np.ones(len(lines), bool)
            followed[np.cumsum(counts) - 1] = False
            style = np.fromiter((_ITEM.match(x) is not None for x in lines), np.int64, len(lines))
            lens = np.fromiter(map(len, lines), np.int64, len(lines)) + 1
            c = _folded("\n".join(lines) + "\n")
            stop = np.cumsum(lens) - 1  # places of the line breaks
            real = c != 10
            real[stop] = False
            line_end, at_last = np.zeros(len(c), bool), np.zeros(len(c), bool)
            inner = lens > 1
            line_end[stop[inner & followed] - 1] = True
            at_last[stop[inner & ~followed] - 1] = True
            after = np.concatenate([marks[c[1:]], [False]])
            use = real & ~at_last
            own = np.repeat(style, lens)
            place = np.arange(len(c)) - np.repeat(stop - lens + 1, lens)  # within the line
            found, uses, ends = [], [], []
            for s in (0, 1, 2):
                mine = use if s == 2 else use & (own == s)
                event = line_end | after if s == 2 else line_end
                found.append(np.array([s])), uses.append(np.array([mine.sum()])), ends.append(np.array([(mine & event).sum()]))
                for order in (1, 2, 3):
                    at = np.flatnonzero(mine[order - 1 :] & (place[order - 1 :] >= order - 1))
                    if not len(at):
                        continue
                    k = _keys(c, order)[at] + s
                    kept = shared.value[_bits(k)]
                    keys, where = np.unique(k[kept], return_inverse=True)
                    found.append(keys), uses.append(np.bincount(where, minlength=len(keys))), ends.append(np.bincount(where, weights=event[order - 1 :][at][kept], minlength=len(keys)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (found, uses, ends)], names=["key", "uses", "ends"])

    return distinct_texts(df, text_col).mapInArrow(run, "key long, uses long, ends long").groupBy("key").agg(F.sum("uses").alias("uses"), F.sum("ends").alias("ends"))


def cut_ends(ends: DataFrame, statistics: DataFrame) -> DataFrame:
    """(tri) of those final n-grams ``ends`` (tri, keys) after which a text of their line style does not end.

    P(end | n-gram) is interpolated with that of the shorter n-gram, down to the share of ends among all characters.
    """
    parts = ends.select("tri", F.posexplode("keys").alias("order", "key")).join(statistics, "key", "left")
    at = lambda c, i: F.coalesce(F.max(F.when(F.col("order") == i, F.col(c))), F.lit(0))
    wide = parts.groupBy("tri").agg(F.min(F.when(F.col("order") == 0, F.col("key"))).alias("style"), *[at(c, i).alias(f"{c}{i}") for c in ("uses", "ends") for i in range(4)])
    base = (F.col("ends0") + 0.01) / (F.col("uses0") + 1.0)
    p = base
    for i in (1, 2, 3):
        p = (F.col(f"ends{i}") + BACKOFF * p) / (F.col(f"uses{i}") + BACKOFF)
    least = F.when(F.col("style") == 2, CLAUSE_RATIO * base).otherwise(F.lit(END_SHARE))
    return wide.where(p < least).select("tri")


def defects(df: DataFrame, id_col: str, question: str, answer: str, languages: Languages) -> DataFrame:
    """(id, defect) of each defective pair: empty, copy, refusal, language or truncated, the first that holds.

    * empty: null, blank, marks or markup only, a placeholder, a label without content.
    * copy: the question again, however often, with marks, labels and lead-in words around it.
    * refusal: the answer opens by declining, in a clause about the answerer or the question, outside quotation marks.
    * language: naive Bayes over character n-grams gives question and answer different languages, by odds in all and by a
      margin a character, so that names and a leading topic don't decide.
    * truncated: the answer has no end mark, and a line of its style (list or prose) is not likely to end after its final
      n-gram, or, if it is a single clause, that n-gram hardly ever ends one; or it ends in dots or in a mark that
      something must follow.

    A null or blank question only rules out copy and language.  Whole texts of any length are read; rows repeated come
    out repeated; extra columns are ignored; an empty table gives no rows.  The model, at most a few MB, is broadcast.
    """
    shared = df.sparkSession.sparkContext.broadcast((languages.names, languages.logs, languages.known, languages.tables))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            model = model or Languages(*shared.value)
            questions, answers = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            found: list[str | None] = ["empty" if is_empty(a) else "copy" if is_copy(q, a) else "refusal" if is_refusal(q, a) else None for q, a in zip(questions, answers)]
            open_rows = [i for i, d in enumerate(found) if d is None and questions[i]]
            for i, other in zip(open_rows, model.differ([questions[i] for i in open_rows], [answers[i] for i in open_rows])):
                if other:
                    found[i] = "language"
            at, keys = [], []
            for i, a in enumerate(answers):
                end = tail(a) if found[i] is None else None
                if end and end[0]:
                    found[i], end = "truncated", None
                if found[i] or end:
                    at.append(i)
                    keys.append(end[1] if end else None)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array([found[i] for i in at], pa.string()), pa.array(keys, pa.list_(pa.int64()))], names=[id_col, "defect", "keys"])

    flagged = cut_lineage(df.select(id_col, question, answer).mapInArrow(run, f"`{id_col}` {kind}, defect string, keys array<long>"))
    decided = flagged.where("defect is not null").select(id_col, "defect")
    pending = flagged.where("defect is null").withColumn("tri", F.element_at("keys", -1))
    ends = cut_lineage(pending.select("tri", "keys").dropDuplicates(["tri"]))
    cut = cut_ends(ends, end_statistics(df, answer, ends.select(F.explode("keys").alias("key"))))
    return decided.unionByName(pending.join(cut, "tri").select(id_col, F.lit("truncated").alias("defect")))
