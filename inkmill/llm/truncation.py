"""Problem 9: texts cut off by field limits, by word trigrams at ends and inside, in pure SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from inkmill.llm.common import FILTER_WORDS, cut_lineage, distinct_texts

#: A final trigram is almost never terminal if lines end after it in less than this share of its uses in lines of its style.
END_SHARE = 0.3
#: A clause mark follows one word in so many; a single clause is cut if its final trigram ends clauses this much less often than that.
CLAUSE_WORDS, CLAUSE_RATIO = 20, 0.25
#: A last line that ends several different texts is whole if that is more often than cuts would fall there by chance: some
#: ten times the share of words that a cut follows, times the uses of its final trigram, and twice the texts that end in
#: that line without its last one or two characters.
CUT_RATE = 0.002

# Fixed values from here on.
#: Words of texts in lower case with 0 for numbers: runs of letters of alphabetic scripts, any other character alone.
WORD = r"[\u3000-\u9FFF\uF900-\uFAFF\uFF00-\uFFEF]|[a-z\u00DF-\u024F\u0370-\u052F\u05D0-\u06FF\u0900-\u0E7F\uAC00-\uD7AF]+|\S"
#: White space, control and invisible characters, as one string.
BLANKS = "".join(map(chr, (*range(0x00, 0x21), *range(0x7F, 0xA1), 0xAD, 0x1680, *range(0x2000, 0x2010), *range(0x2028, 0x2030), *range(0x205F, 0x2065), 0x3000, 0xFEFF)))
#: What a cut leaves behind: broken characters, entities, tags and brackets, dots.
SCRAP = r"(?:[\s\p{Z}\p{Cc}\p{Cf}]|\uFFFD|…|\.{2,}|。{2,}|·{2,}|&[#A-Za-z0-9]{0,6};?|</?[A-Za-z]{0,10}|<[A-Za-z]{1,10}\s*/?>|[\[［][^\[\]［］\n]{0,4})+$"
END = r"(?:[。！？!?．︒｡؟।]|\.)[”’」』）)\]】》〉\"'»›*_`]*$"
#: A sentence end anywhere in a text.
SENTENCE = r"[。！？!?．｡؟।]|[\p{L})”\"]\.(?:\s|$)"
#: Last lines that end whole without a sentence end.
WHOLE = "^(?:" + "|".join(
    (
        r"={2,}.*={2,}", r"(?i:(?:-+\s*)?page\s+\d+(?:\s+of\s+\d+)?.*)", r"第\s*\d+\s*页.*", r"-*\s*\d+\s*-*",  # page markers
        r"[（(【\[<-]+\s*(?i:完|终|全文完|end|eof|the end|fin|ende|終わり?|以上)\s*[）)】\]>-]+", r"(?i:the end|end|eof|fin|ende|以上|完)",  # end marks
        r"(?:——|—|–|--|~|―)\s*[^，,；;。]{1,40}",  # signatures
        r"(?i:编号|联系人|电话|日期|作者|来源|签发|审核|ref|reference|no|contact|date|author|source|tel|e-?mail|番号|担当|日付|datum|kontakt|az|nr)\.?\s*[：:]\s*[^，,；;。]{1,60}",  # references, contacts
        r"[^，,；;。]{0,12}\d{1,4}\s*[年/.-]\s*\d{1,2}\s*[月/.-]\s*\d{1,4}\s*日?", r"(?i:\d{1,2}\.?\s+\p{L}+\s+\d{4})", r"(?i:\p{L}+\s+\d{1,2},?\s+\d{4})",  # dates
        r"[^，,；;。]{0,20}(?i:https?|ftp)://\S+", r"[^，,；;。]{0,20}(?i:www)\.\S+", r"[^，,；;。]{0,20}\S+@\S+\.\w+",  # links
        r".*\t.*", r"\|.*", r".*\|",  # table rows
        r"#{1,6}\s.*", r"(?:\d{1,3}\.)*\d{1,3}\.?\s+[^，,；;。]{1,40}", r"[一二三四五六七八九十]{1,3}、[^，,；;。]{1,30}", r"第[一二三四五六七八九十百\d]{1,5}[章节部分篇条].{0,30}",  # titles
        r"(?i:附表|附件|附录|图|表|圖|table|figure|fig\.|section|chapter|appendix|abschnitt|tabelle|abbildung|kapitel|anhang|図|付表)\s*[\dA-Z]{1,4}\b[^，,；;。]{0,60}",
        r"[\p{Lu}\d\s'-]{3,60}",  # a title in capitals
    )
) + r")\s*$"
#: A list item of a few characters is a whole name.
ITEM = r"^\s*[•●○■◆▪‣*+-]\s*[^\s，,；;。！？!?]{1,4}$"
#: How an item of a list begins; its ends count apart from those of other lines.
MARKER = r"^\s*(?:[•●○■◆▪‣*+·-]|\d{1,3}[.、)）]|[(（]\d{1,3}[)）]|[①-⑳])"
#: Marks that end a clause; a single line without any is a name or a single clause.
MARKS = "，,；;。：:！？!?"
CLAUSE = f"[{MARKS}]"
#: Line breaks but the first are turned into it.
LINE_BREAKS = "\n\r\v\f\x85\u2028\u2029"

_CANDIDATES = """
    WITH ended AS (
        -- a lateral view keeps what it computes; a subquery's expressions would be copied into every use of them
        SELECT doc_id AS k, text, bare, last, line FROM {docs}
        LATERAL VIEW inline(array(named_struct('bare', translate(rtrim(:blanks, text), :breaks, repeat('\n', 7))))) AS bare
        LATERAL VIEW inline(array(named_struct('last', substring_index(bare, '\n', -1)))) AS last
        -- scraps are looked for in the last line, and in the whole text only if that line is nothing else
        LATERAL VIEW inline(array(named_struct('cleaned', regexp_replace(last, :scrap, '')))) AS cleaned
        LATERAL VIEW inline(array(named_struct('line', trim(CASE WHEN cleaned <> '' THEN cleaned ELSE substring_index(regexp_replace(bare, :scrap, ''), '\n', -1) END)))) AS line
        WHERE text IS NOT NULL AND bare <> ''
    ), judged AS (
        SELECT k, xxhash64(text) AS h, line, length(line) < length(trim(last)) OR line = '' OR last NOT LIKE concat('%', line) AS scrap, bare, contains(bare, '\n') AS several, NOT bare RLIKE :clause AS single FROM ended WHERE line <> ''
    ), candidates AS (
        SELECT k, h, line, single AND NOT several AS fragment FROM judged
        WHERE (scrap OR NOT line RLIKE :end) AND NOT line RLIKE :whole AND NOT line RLIKE :item
          AND (NOT several OR bare RLIKE :sentence)
    ), worded AS (
        SELECT k, h, xxhash64(plain) AS whole, xxhash64(left(plain, length(plain) - 1)) AS shorter, xxhash64(left(plain, length(plain) - 2)) AS shortest, fragment, line RLIKE :marker AS item,
               concat(array('^', '^'), regexp_extract_all(lower(plain), :word, 0)) AS w
        FROM candidates LATERAL VIEW inline(array(named_struct('plain', regexp_replace(line, '[0-9]+', '0')))) AS plain
    )
    SELECT k, h, whole, shorter, shortest, fragment, item, xxhash64(get(w, size(w) - 3), get(w, size(w) - 2), get(w, size(w) - 1)) AS tri FROM worded WHERE size(w) > 2
"""

_TRIGRAMS = """
    WITH parts AS (
        SELECT lines, size(lines) AS n FROM {texts} LATERAL VIEW inline(array(named_struct('lines', split(translate(rtrim(:blanks, text), :breaks, repeat('\n', 7)), '\n')))) AS lines
    ), lines AS (
        SELECT posexplode(lines) AS (at, raw), n FROM parts
    ), styled AS (
        -- whether a line ends whole matters only where no mark stands at its end
        SELECT line, item, followed, followed AND NOT contains(:marks, right(line, 1)) AND (item OR NOT (line RLIKE :whole)) AS ended
        FROM lines LATERAL VIEW inline(array(named_struct('line', trim(raw), 'followed', at < n - 1, 'item', raw RLIKE :marker))) AS line, followed, item WHERE line <> ''
    ), worded AS (
        SELECT item, followed, ended, concat(array('^', '^'), regexp_extract_all(lower(regexp_replace(line, '[0-9]+', '0')), :word, 0)) AS w FROM styled
    ), rows AS (
        SELECT item, followed, ended, inline(arrays_zip(w, slice(w, 2, size(w)), slice(w, 3, size(w)), slice(w, 4, size(w)))) AS (a, b, c, d) FROM worded
    )
    -- what stands at the very end of a text is no evidence
    SELECT xxhash64(a, b, c) AS tri, item, d IS NULL AND ended AS line_end, d IS NULL OR contains(:marks, d) AS clause_end FROM rows WHERE c IS NOT NULL AND (d IS NOT NULL OR followed)
"""

_WORDS = "SELECT tri & :mask AS word, bit_or(shiftleft(1L, CAST(shiftrightunsigned(tri, 20) & 63 AS INT))) AS bits FROM {final} GROUP BY 1"

_COUNTS = """
    SELECT /*+ BROADCAST(words) */ tri, item, count(*) AS uses, count_if(line_end) AS ends, count_if(clause_end) AS clause_ends
    FROM {trigrams} JOIN {words} AS words ON tri & :mask = word WHERE getbit(bits, CAST(shiftrightunsigned(tri, 20) & 63 AS INT)) = 1 GROUP BY tri, item
"""

_CASES = """
    WITH clauses AS (SELECT tri, sum(uses) AS all_uses, sum(clause_ends) AS all_ends FROM {counts} GROUP BY tri),
    rated AS (
        SELECT tri, item, coalesce(uses, 0) AS uses, coalesce(ends, 0) < :end_share * (coalesce(uses, 0) + 1) AS line_cut,
               coalesce(all_ends, 0) + 1 < :clause_ratio * (coalesce(all_uses, 0) / :clause_words + 1) AS clause_cut
        FROM (SELECT DISTINCT tri, item FROM {final}) LEFT JOIN {counts} USING (tri, item) LEFT JOIN clauses USING (tri)
    ), last_lines AS (
        SELECT whole, shorter, shortest, count(DISTINCT h) AS n FROM {final} GROUP BY whole, shorter, shortest
    ), recurring AS (
        SELECT x.whole, x.n - 1 AS again FROM last_lines x LEFT JOIN last_lines y ON x.shorter = y.whole LEFT JOIN last_lines z ON x.shortest = z.whole
        WHERE x.n > 1 AND x.n - 1 > 2 * (coalesce(y.n, 0) + coalesce(z.n, 0))
    )
    SELECT k AS doc_id FROM {final} JOIN rated USING (tri, item) LEFT JOIN recurring USING (whole)
    WHERE CASE WHEN fragment THEN clause_cut ELSE line_cut END AND NOT coalesce(again, 0) > :cut_rate * uses
"""


def truncated(docs: DataFrame) -> DataFrame:
    """(doc_id) of each text that was cut off.

    1. Scraps and dots at the end are taken off.  Null, blank and one-word texts, texts that end in a sentence end
       without scraps, texts of several lines without any sentence end, and texts whose last line is a title, signature,
       date, reference, short list item, table row, link or page marker are no cases, by definition.
    2. Word trigrams are counted in all lines of all different texts (copies once), by line style (list items apart from
       other lines): their uses, and how often a line ends after them that another line follows and that is no title or
       the like.  What stands at the very end of a text is no evidence: it is where cuts fall.  Only trigrams that may
       be final ones of step 1 are aggregated (a filter of bounded size), so the shuffle is that of the ends.
    3. A text is a case if its final trigram is almost never terminal: lines end after it in less than END_SHARE of its
       uses (one use more, so that trigrams that stand nowhere else, as words cut in the middle, are never terminal).
       It is none if its last line ends several different texts, more often than cuts would by chance (CUT_RATE).
       A text of one line without any clause mark may be a name: it takes evidence to flag it, a trigram that ends
       clauses less often than CLAUSE_RATIO times the average word.

    Rows repeated in docs come out repeated; extra columns are ignored; an empty table gives no rows.
    """
    sql = docs.sparkSession.sql
    fixed = {"blanks": BLANKS, "breaks": LINE_BREAKS, "word": WORD, "whole": WHOLE, "marker": MARKER}
    mask = {"mask": FILTER_WORDS - 1}
    final = cut_lineage(sql(_CANDIDATES, args=fixed | {"clause": CLAUSE, "scrap": SCRAP, "end": END, "item": ITEM, "sentence": SENTENCE}, docs=docs))
    trigrams = sql(_TRIGRAMS, args=fixed | {"marks": MARKS}, texts=distinct_texts(docs, "text"))
    counts = cut_lineage(sql(_COUNTS, args=mask, trigrams=trigrams, words=sql(_WORDS, args=mask, final=final)))
    return sql(_CASES, args={"end_share": END_SHARE, "clause_words": CLAUSE_WORDS, "clause_ratio": CLAUSE_RATIO, "cut_rate": CUT_RATE}, final=final, counts=counts)


def truncation_report(docs: DataFrame, cases: DataFrame) -> DataFrame:
    """One row a source (null included): source, texts, truncated, share.  Null texts count among no source's texts."""
    return docs.sparkSession.sql(
        """
        SELECT source, count(text) AS texts, count(c.doc_id) AS truncated, try_divide(count(c.doc_id), count(text)) AS share
        FROM {docs} d LEFT JOIN (SELECT DISTINCT doc_id FROM {cases}) c USING (doc_id) GROUP BY source
        """,
        docs=docs,
        cases=cases,
    )
