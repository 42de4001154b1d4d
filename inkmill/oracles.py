"""SQL for DuckDB that each query is checked against.  RE2 has ASCII classes only, so Unicode ones are spelled out."""

from __future__ import annotations

from inkmill.functions import rules
from inkmill.operators.quality import COUNTERS

S = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]".replace(r"\x{1C}-\x{1F}", "")
NS = "[^" + S[1:]
W = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}]"
NW = "[^" + W[1:]
HAN = r"\x{4e00}-\x{9fa5}"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(c: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({c}, {q(pattern)}, {q(to)}, 'g')"


def has(c: str, pattern: str) -> str:
    return f"regexp_matches({c}, {q(pattern)})"


def strip(c: str) -> str:
    return sub(c, f"^{S}+|{S}+$")


def any_of(c: str, words) -> str:
    return "(" + " OR ".join(f"contains({c}, {q(w)})" for w in words) + ")"


PAGE = rf"==={S}*第{S}*\p{{Nd}}+{S}*页{S}*==="
CONTROL = r"[\x00-\x1F\x{7F}-\x{9F}]"


def clean_gen(c: str) -> str:
    c = sub(sub(f"coalesce({c}, '')", CONTROL), PAGE)
    return strip(sub(sub(c, f"{S}+", " "), rf"([。！？!?;；]){S}+", r"\1"))


def clean_fix(c: str) -> str:
    """As a subquery-free expression over a lambda-bound value."""
    c0 = sub(sub(f"coalesce({c}, '')", CONTROL), "[《》]$")
    step = f"list_transform([translate({c0}, '《》', '\"\"')], lambda x: CASE WHEN {strip('x')} = '' OR {has(strip('x'), '[？?!！]$')} THEN x WHEN {has('x', NW + '$')} THEN left(x, length(x) - 1) || '？' ELSE x || '？' END)[1]"
    out = sub(sub(step, f"{S}+", " "), PAGE)
    return strip(sub(sub(out, rf"([。！？!?;；]){S}+", r"\1"), '"{2,}', '"'))


def kind(x: str) -> str:
    title = [rf"^[\p{{Nd}}\.]+{S}+[{HAN}a-zA-Z{S[1:-1]}]{{3,30}}$", rf"^[一二三四五六七八九十]+(?:[、.]|{S})[{HAN}a-zA-Z{S[1:-1]}]{{3,30}}$", rf"^第[一二三四五六七八九十]+[章节]{S}*[{HAN}a-zA-Z{S[1:-1]}]{{3,30}}$", rf"^[{HAN}a-zA-Z{S[1:-1]}]{{2,20}}[:：]$"]
    figure = rf"(?:图|表|Figure|Table){S}*\p{{Nd}}+[\.:：][{HAN}a-zA-Z{S[1:-1]}]+"
    items = [rf"^\p{{Nd}}+[\.)]{S}+", rf"^[a-zA-Z][\.)]{S}+", rf"^[•\-*]{S}+", rf"^[\(（]\p{{Nd}}+[\)）]{S}+"]
    return f"CASE WHEN {x} = '' THEN 'blank' WHEN {' OR '.join(has(x, p) for p in title)} THEN 'title' WHEN {has(x, figure)} THEN 'figure' WHEN {' OR '.join(has(x, p) for p in items)} THEN 'list' ELSE 'text' END"


def line_rows() -> str:
    """CTEs l and k: the lines of documents with kind, line (a figure's caption) and tagged form."""
    captions = ", ".join(f"nullif(regexp_extract(raw, {q(p)}), '')" for p in (rf"(?:{w}){S}*\p{{Nd}}+[\.:：][{HAN}a-zA-Z{S[1:-1]}]+" for w in ("图", "表", "Figure", "Table")))
    return f"""WITH l AS (SELECT doc_id, unnest(range(len(a)))::INT AS line_no, unnest(a) AS raw FROM (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: {strip('x')}) AS a FROM documents WHERE text IS NOT NULL)),
        k AS (SELECT doc_id, line_no, {kind('raw')} AS kind, CASE WHEN kind = 'figure' THEN coalesce({captions}) ELSE raw END AS line,
                     CASE kind WHEN 'title' THEN chr(10) || '<标题>' || line || '</标题>' || chr(10) WHEN 'figure' THEN chr(10) || '<图表>' || line || '</图表>' || chr(10) WHEN 'list' THEN '<列表项>' || line || '</列表项>' ELSE line END AS out FROM l)"""


def valid_topic(t: str) -> str:
    bad = [f"length({t}) < 3", any_of(t, rules.TOPIC_BAD_PARTS), has(t, rf"^[\p{{Nd}}.,;:{S[1:-1]}]+$"), *[f"starts_with({t}, {q(x)}) OR ends_with({t}, {q(x)})" for x in rules.TOPIC_STOPS], f"{t} IN ({', '.join(map(q, rules.TOPIC_GENERIC))})", has(t, rf"^的{W}{{1,3}}$")]
    return f"NOT ({' OR '.join(bad)})"


def topic(c: str) -> str:
    """The topic cascade over a cleaned, non-empty text; rules in the order in which the survey lists them."""
    let = lambda value, body: f"list_transform([{value}], lambda g: {body})[1]"
    ws = W[:-1] + S[1:]
    steps = [let(strip(f"regexp_extract({c}, {q(f'({ws}{{2,20}})[（(]([^)）]+)[)）]技术[:：]')}, 1)"), f"CASE WHEN length(g) > 2 AND {valid_topic('(g || ' + q('技术') + ')')} THEN g || '技术' END")]
    for term in rules.KNOWN_TERMS:
        said = has(c, f"(?i){term}([：:](技术定义|原理|是指)|是指|指的是|被定义为)")
        often = f" OR length({c}) - length(replace({c}, {q(term)}, '')) >= 3 * {len(term)}" if len(term) > 4 else ""
        steps.append(f"CASE WHEN {said}{often} THEN {q(term)} END")
    for tail in ("(技术定义与原理|是一种|技术是指)", "[:：](技术定义|原理|是指|指的是|包括|涵盖)", "是[供物仓运输链智能].*?领域.*?的.*?技术"):
        named = "CASE WHEN contains(g, '技术') THEN g ELSE g || '技术' END"
        steps.append(let(strip(f"regexp_extract({c}, {q(f'({ws}{{4,25}})' + tail)}, 1)"), f"CASE WHEN length(g) > 3 AND {valid_topic(f'({named})')} THEN {named} END"))
    for noun in rules.TOPIC_NOUNS:
        found = f"list_filter(regexp_extract_all(left({c}, 200), {q(f'{W}{{2,15}}{noun}')}), lambda m: length(m) > 4 AND {valid_topic('m')})"
        steps.append(let(found, "list_filter(g, lambda x: length(x) = list_max(list_transform(g, lambda y: length(y))))[1]"))
    steps.append(let(f"regexp_extract({c}, {q(f'({W}{{2,15}})(与|和)(安全|责任|挑战|限制|问题)')}, 1)", f"CASE WHEN g <> '' AND {valid_topic('(g || ' + q('技术') + ')')} THEN g || '技术' END"))
    steps.append(f"CASE WHEN contains({c}, '自动驾驶') AND (contains({c}, '卡车') OR contains({c}, '物流')) THEN '自动驾驶卡车技术' WHEN contains({c}, '自动驾驶') AND (contains({c}, '责任归属') OR contains({c}, '安全与责任')) THEN '自动驾驶技术' END")
    steps.append(f"CASE WHEN contains({c}, '仓库') OR contains({c}, 'WMS') THEN '仓库管理技术' WHEN contains({c}, '物流') THEN '物流技术' WHEN contains({c}, '供应链') THEN '供应链技术' ELSE '供应链执行技术' END")
    return f"coalesce({', '.join(steps)})"


def related(t: str, c: str) -> str:
    """A topic that the content supports."""
    strong = f"CASE WHEN (ends_with({t}, '的因素') OR starts_with({t}, '的') OR length({t}) < 4) THEN CASE WHEN contains({c}, '自动驾驶') THEN '自动驾驶技术' WHEN contains({c}, '仓库') THEN '仓库管理技术' WHEN contains({c}, '供应链') THEN '供应链技术' ELSE {t} END ELSE {t} END"
    known = "CASE " + " ".join(f"WHEN contains({c}, {q(k)}) THEN {q(k)}" for k in rules.KNOWN_TERMS) + " END"
    return f"list_transform([{strong}], lambda s: CASE WHEN len(list_filter(regexp_extract_all(s, {q(W + '+')}), lambda w: length(w) > 1 AND contains({c}, w))) > 0 THEN s ELSE coalesce(CASE WHEN length(s) > 2 THEN {known} END, '供应链执行技术') END)[1]"


FILES = """
    WITH raw AS (
        SELECT 1 AS file_ord, qa_id, "user" AS question, assistant AS answer, topic, dimension, difficulty FROM qa_instructions_robust
        UNION ALL
        SELECT 2, qa_id, list_filter(conversations, lambda t: t.role = 'user')[-1].content, list_filter(conversations, lambda t: t.role = 'assistant')[-1].content, topic, dimension, difficulty FROM qa_chat
    ), files AS (
        SELECT *, coalesce(question <> '' AND (file_ord, qa_id) > min((file_ord, qa_id)) OVER (PARTITION BY question), false) AS dup_question,
               coalesce(left(answer, 50) <> '' AND (file_ord, qa_id) > min((file_ord, qa_id)) OVER (PARTITION BY left(answer, 50)), false) AS dup_answer
        FROM raw
    )"""


def _bad(c: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({c}, {'chr(1)' if p == chr(1) else q(p)}) THEN {'chr(1)' if p == chr(1) else q(p)}" for p in rules.BAD_PARTS) + " END"


def _rules() -> dict[str, tuple[list[tuple[str, int, str, str | None]], str, str, str | None]]:
    stops = ", ".join(q(s) for s in rules.QUESTION_STOPS)
    ratio = lambda terms: f"coalesce(len(list_filter({terms}, lambda w: length(w) > 1 AND contains(lower(answer), w))) / nullif(len({terms}), 0), 0)"
    by_topic = ratio(f"list_distinct(regexp_extract_all(lower(coalesce(topic, '')), '{W}+'))")
    by_word = ratio(f"list_filter(list_distinct(regexp_extract_all(lower(question), '{W}+')), lambda k: k NOT IN ({stops}))")
    tok = lambda c: f"(length({c}) // 3)"
    blacklist = ", ".join(q(x) for x in rules.TOPIC_BLACKLIST)
    question = [
        ("length(question) < 10", 30, "'问题过短(' || length(question) || '<10)'", "incomplete_question"),
        ("length(question) > 75", 10, "'问题过长(' || length(question) || '>75.0)'", None),
        (f"{tok('question')} < 5", 20, f"'问题token数过少(' || {tok('question')} || '<5)'", None),
        (f"{tok('question')} > 37.5", 10, f"'问题token数过多(' || {tok('question')} || '>37.5)'", None),
        ("NOT (ends_with(question, '？') OR ends_with(question, '?'))", 15, "'问题不以问号结尾'", "no_question_mark"),
        (f"({_bad('question')}) IS NOT NULL", 25, f"'问题包含无效字符 ''' || ({_bad('question')}) || ''''", "invalid_chars"),
        ("dup_question", 50, "'问题与现有问题重复'", "duplicate_qa"),
    ]
    answer = [
        ("length(answer) < 100", 30, "'答案过短(' || length(answer) || '<100)'", "too_short_answer"),
        ("length(answer) > 1200", 15, "'答案过长(' || length(answer) || '>1200.0)'", "too_long_answer"),
        (f"{tok('answer')} < 50", 20, f"'答案token数过少(' || {tok('answer')} || '<50)'", None),
        (f"{tok('answer')} > 525", 10, f"'答案token数过多(' || {tok('answer')} || '>525.0)'", None),
        (f"({_bad('answer')}) IS NOT NULL", 25, f"'答案包含无效字符 ''' || ({_bad('answer')}) || ''''", "invalid_chars"),
        ("dup_answer", 20, "'答案与现有答案相似'", "duplicate_qa"),
    ]
    metadata = [
        (f"(topic = '' OR lower(topic) IN ({blacklist}))", 20, "'无效主题: ' || topic", "invalid_topic"),
        ("(starts_with(topic, '的') OR ends_with(topic, '的因素') OR topic = '责任归属')", 15, "'主题格式可能不正确: ' || topic", "invalid_topic"),
        (f"dimension NOT IN ({', '.join(q(x) for x in rules.DIMENSIONS)})", 10, "'无效维度: ' || dimension", "invalid_dimension"),
        (f"difficulty NOT IN ({', '.join(q(x) for x in rules.TEMPLATES)})", 10, "'无效难度: ' || difficulty", None),
    ]
    relevance = [
        (f"{by_topic} < 0.3", 30, "'答案中未充分包含主题''' || coalesce(topic, '') || '''相关内容'", "topic_mismatch"),
        (f"{by_word} < 0.3", 40, "'问题与答案内容不匹配'", "question_answer_mismatch"),
        (f"({by_word} >= 0.3 AND {by_word} < 0.5)", 20, "'问题与答案相关性较低'", None),
        (f"({has('question', '(什么是|定义|解释|概念)')} AND NOT contains(left(answer, 100), '是'))", 15, "'问题询问定义但答案未提供直接解释'", None),
        (f"(contains(question, '为什么') AND NOT {any_of('left(answer, 200)', rules.CAUSE_WORDS)})", 15, "'问题询问原因但答案未提供清晰解释'", None),
        ("(contains(coalesce(topic, ''), '责任归属') AND NOT contains(coalesce(topic, ''), '自动驾驶') AND contains(answer, '自动驾驶'))", 25, "'主题''责任归属''可能应为''自动驾驶技术''的一部分'", "topic_mismatch"),
    ]
    no_q, no_a = "coalesce(question, '') = ''", "coalesce(answer, '') = ''"
    return {
        "question_score": (question, no_q, "'问题为空'", "incomplete_question"),
        "answer_score": (answer, no_a, "'答案为空'", "too_short_answer"),
        "metadata_score": (metadata, "false", "''", None),
        "relevance_score": (relevance, f"({no_q} OR {no_a})", "'问题或答案为空'", None),
    }


def _scored() -> str:
    score, issues, hits = [], [], {c: [] for c in COUNTERS}
    for name, (checks, empty, message, when_empty) in _rules().items():
        score.append(f"CASE WHEN {empty} THEN 0 ELSE 100 - ({' + '.join(f'CASE WHEN {c} THEN {p} ELSE 0 END' for c, p, _, _ in checks)}) END::BIGINT AS {name}")
        issues.append(f"CASE WHEN {empty} THEN [{message}] ELSE list_filter([{', '.join(f'CASE WHEN {c} THEN {m} END' for c, _, m, _ in checks)}], lambda i: i IS NOT NULL) END")
        if when_empty:
            hits[when_empty].append(f"coalesce({empty}, false)::INT")
        for c, _, _, counter in checks:
            if counter:
                hits[counter].append(f"coalesce(NOT {empty} AND {c}, false)::INT")
    counts = ", ".join(f"{' + '.join(h)} AS n_{k}" for k, h in hits.items())
    return FILES + f""", parts AS (SELECT *, {', '.join(score)}, {' || '.join(issues)} AS issue_list, {counts} FROM files),
        scored AS (SELECT *, round(question_score * 0.3::DOUBLE + answer_score * 0.3::DOUBLE + metadata_score * 0.1::DOUBLE + relevance_score * 0.3::DOUBLE, 1) AS total_score FROM parts)"""


def _fix_question(user: str = '"user"') -> str:
    cut = " OR ".join(has("x", p) for p in rules.CUT_QUESTIONS)
    key = f"regexp_extract(x, '({W[:-1]}{S[1:]}{{2,}})', 1)"
    body = f"""CASE WHEN {cut} THEN CASE WHEN {key} = '' THEN {q(rules.QUESTION_UNKNOWN)} ELSE '什么是' || {strip(key)} || '？它有什么作用？' END
        WHEN contains(x, '哪些公司最') AND length(x) < 15 THEN {q(rules.QUESTION_COMPANIES)} WHEN length(x) < 10 THEN {q(rules.QUESTION_SHORT)}
        WHEN ends_with(x, '？') OR ends_with(x, '?') THEN x ELSE x || '？' END"""
    return f"CASE WHEN coalesce({user}, '') = '' THEN {q(rules.QUESTION_EMPTY)} ELSE list_transform([{clean_fix(user)}], lambda x: {body})[1] END"


def _fix_answer(assistant: str = "assistant") -> str:
    ended = f"CASE WHEN {has('x', f'[,，:：;；]{S}*$')} THEN left(x, length(x) - 1) || '。' ELSE x END"
    body = f"list_transform([list_transform([{sub('y', PAGE)}], lambda x: {ended})[1]], lambda z: CASE WHEN ends_with(z, '包括') OR ends_with(z, '例如') OR ends_with(z, '有') THEN z || {q(rules.ANSWER_TAIL)} ELSE z END)[1]"
    return f"CASE WHEN length(coalesce({assistant}, '')) < 50 THEN {q(rules.ANSWER_SHORT)} ELSE list_transform([{clean_fix(assistant)}], lambda y: {body})[1] END"


def json_object(fields: list[tuple[str, str]]) -> str:
    """A JSON object without the fields that are null."""
    parts = ", ".join(f"""'"{name}":' || {value}""" for name, value in fields)
    return f"'{{' || array_to_string(list_filter([{parts}], lambda x: x IS NOT NULL), ',') || '}}'"


def text_json(c: str) -> str:
    return f"to_json({c})::VARCHAR"


def answer() -> str:
    """CTE a (segment_id, answer): the answer of each segment, by list functions that fold over its sentences."""
    segs = "(SELECT segment_id, any_value(content) AS content FROM segmented_content GROUP BY segment_id)"
    tok, join = "length(array_to_string({}, ' ')) // 3", "array_to_string({}, ' ')"
    defined = "list_filter(s, lambda x: " + any_of("x", rules.ANSWER_DEFINITIONS) + ")[1:1]"
    keyed = f"flatten(list_transform([{', '.join(map(q, rules.ANSWER_KEYS))}], lambda k: list_filter(s, lambda x: contains(x, k))))"
    # each key sentence is taken unless it is there or the selection is beyond 0.7 of the budget
    with_keys = f"list_reduce({keyed}, lambda acc, x: CASE WHEN list_contains(acc, x) OR (len(acc) > n0 AND {tok.format('acc')} > 245) THEN acc ELSE list_append(acc, x) END, sel)"
    filled = f"list_reduce(s, lambda acc, x: CASE WHEN acc.stop OR list_contains(acc.sel, x) THEN acc WHEN {tok.format('list_append(acc.sel, x)')} <= 350 THEN {{'sel': list_append(acc.sel, x), 'stop': false}} ELSE {{'sel': acc.sel, 'stop': true}} END, {{'sel': sel, 'stop': false}}).sel"
    return f"""c AS (SELECT segment_id, content, {clean_gen('content')} AS cleaned FROM {segs}),
        sents AS (SELECT *, list_filter(list_transform(regexp_extract_all(cleaned, '[^。！？!?;；]*[。！？!?;；]'), lambda x: {strip('x')}), lambda x: x <> '') AS s FROM c),
        first AS (SELECT *, {defined} AS sel, len({defined}) AS n0 FROM sents), keys AS (SELECT * EXCLUDE (sel), {with_keys} AS sel FROM first),
        full_sel AS (SELECT *, {filled} AS done FROM keys),
        a AS (SELECT segment_id, content, CASE WHEN coalesce(content, '') = '' THEN {q(rules.APOLOGY)} WHEN length(cleaned) // 3 <= 350 THEN cleaned
                     ELSE {clean_gen(f"CASE WHEN length({join.format('done')}) < 50 THEN {join.format('s[1:3]')} ELSE {join.format('done')} END")} END AS answer FROM full_sel)"""


def topics() -> str:
    """CTE t (segment_id, content, topic): the topic extracted from each segment."""
    segs = "(SELECT segment_id, any_value(content) AS content FROM segmented_content GROUP BY segment_id)"
    return f"t AS (SELECT segment_id, content, CASE WHEN coalesce(content, '') = '' THEN '供应链技术' ELSE list_transform([{clean_gen('content')}], lambda c: {topic('c')})[1] END AS topic FROM {segs})"


def templates() -> str:
    rows = [(d, i, f, k, x) for i, (d, fs) in enumerate(rules.DIMENSIONS.items()) for f in fs for k, x in enumerate(rules.TEMPLATES[f])]
    return "tm AS (SELECT * FROM (VALUES " + ", ".join(f"({q(d)}, {i}, {q(f)}, {k}, {q(x)})" for d, i, f, k, x in rows) + ") AS v(dimension, dim_no, difficulty, tmpl_no, template))"


def build() -> dict[str, str]:
    scored = _scored()
    user, reports = '"user"', ", ".join(f"sum(n_{c})::BIGINT AS {c}" for c in COUNTERS)
    report = f"""SELECT file_ord, count(*) AS total_pairs, coalesce(round(avg(total_score), 1), 0) AS average_score, count(*) FILTER (total_score >= 90) AS excellent,
        count(*) FILTER (total_score >= 75 AND total_score < 90) AS good, count(*) FILTER (total_score >= 60 AND total_score < 75) AS fair, count(*) FILTER (total_score < 60) AS poor, {reports} FROM scored GROUP BY file_ord"""
    lines = f"""WITH l AS (SELECT doc_id, unnest(range(len(a))) AS line_no, unnest(a) AS line FROM (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: {strip('x')}) AS a FROM documents WHERE text IS NOT NULL)),
        k AS (SELECT *, {kind('line')} AS kind FROM l)"""
    sents = f"""WITH p AS (SELECT doc_id, unnest(range(len(a))) AS para_idx, unnest(a) AS p FROM (SELECT doc_id, string_split_regex(text, '\\n{S}*\\n') AS a FROM documents WHERE text IS NOT NULL)),
        s AS (SELECT doc_id, para_idx, unnest(range(len(a))) AS sent_idx, unnest(a) AS sentence FROM (SELECT doc_id, para_idx, list_filter(list_transform(string_split_regex(p, '[。！？\\.!?]'), lambda x: {strip('x')}), lambda x: x <> '') AS a FROM p))"""
    sound = f"coalesce(length({user}) >= 5 AND length(assistant) >= 50 AND ({_bad(user)}) IS NULL AND ({_bad('assistant')}) IS NULL, false)"
    needs = f"(length(coalesce({user}, '')) < 10 OR {any_of(f'coalesce({user}, {q(str())})', ('》', '《'))} OR length(coalesce(assistant, '')) < 100 OR contains(coalesce(assistant, ''), '==='))"
    valid = valid_topic("topic")
    formatted = sub(sub(sub("text", "<[^>]+>"), r"\n{3,}", "\n\n"), rf"([。！？\.!?]){S}*\n({NS})", r"\1" + "\n\n" + r"\2")
    formatted = sub(sub(formatted, rf"([。，；：！？])({NS})", r"\1 \2"), f"{S}+", " ")
    segs = "(SELECT segment_id, any_value(content) AS content FROM segmented_content GROUP BY segment_id)"
    balanced = scored + """, high AS (SELECT * FROM scored WHERE total_score >= 85),
        a AS (SELECT coalesce(dimension, 'unknown') AS c, count(*) AS n FROM high GROUP BY ALL), b AS (SELECT coalesce(difficulty, 'unknown') AS c, count(*) AS n FROM high GROUP BY ALL),
        u AS (SELECT coalesce((SELECT min(n) < max(n) / 3 FROM a), false) OR coalesce((SELECT min(n) < max(n) / 3 FROM b), false) AS uneven),
        x AS (SELECT file_ord, qa_id, total_score, true AS extra FROM scored, u WHERE uneven AND total_score >= 75 AND total_score < 85
              AND (coalesce(dimension, 'unknown') IN (SELECT c FROM a WHERE n = (SELECT min(n) FROM a)) OR coalesce(difficulty, 'unknown') IN (SELECT c FROM b WHERE n = (SELECT min(n) FROM b)))
              ORDER BY total_score DESC, file_ord, qa_id LIMIT 20),
        best AS (SELECT file_ord, qa_id, total_score, false AS extra FROM high UNION ALL SELECT * FROM x)"""
    # the address rules without lookaround, with Unicode white space spelled out
    tld, name = "com|org|net|cn|io|ai", r"[a-zA-Z0-9\.-]+"
    addresses = (
        rf"{S}+https?://{name}\.[a-zA-Z]{{2,}}{NS}*", rf"{S}+www\.{name}\.[a-zA-Z]{{2,}}{NS}*", rf"{S}+{name}\.(?:{tld}){NS}*", rf"{S}+\([^)]*?(?:https?://|www\.)[^)]*?\)", rf"{S}+（[^）]*?(?:https?://|www\.)[^）]*?）",
        rf"{S}+\([^)]*?{name}\.(?:{tld})[^)]*?\)", rf"{S}+（[^）]*?{name}\.(?:{tld})[^）]*?）",
    )
    return {
        "clean_text_gen": f"SELECT doc_id, {clean_gen('text')} AS cleaned FROM documents",
        "clean_text_fix": f"SELECT qa_id, {clean_fix(user)} AS cleaned FROM qa_instructions_robust",
        "token_count": "SELECT doc_id, length(coalesce(text, '')) // 3 AS tokens FROM documents",
        "line_structure": line_rows() + " SELECT doc_id, line_no, kind, line, out FROM k",
        "list_regions": line_rows() + f", d AS (SELECT doc_id, string_agg(out, chr(10) ORDER BY line_no) AS t FROM k GROUP BY doc_id) SELECT doc_id, {sub('t', '((?:<列表项>[^' + chr(92) + 'n<]*</列表项>' + S + '*){2,})', chr(10) + '<列表区域>' + chr(10) + chr(92) + '1' + chr(10) + '</列表区域>' + chr(10))} AS text FROM d UNION ALL SELECT doc_id, NULL FROM documents WHERE text IS NULL",
        "remove_redundant": sents
        + ", r AS (SELECT *, length(sentence) > 10 AND row_number() OVER (PARTITION BY doc_id, lower(sentence) ORDER BY para_idx, sent_idx) > 1 AS dup FROM s), p2 AS (SELECT doc_id, para_idx, string_agg(sentence, '。' ORDER BY sent_idx) FILTER (NOT dup) || '。' AS p, count(*) FILTER (dup) AS n FROM r GROUP BY ALL),"
        + " w AS (SELECT doc_id, string_agg(p, chr(10) || chr(10) ORDER BY para_idx) AS text, sum(n)::BIGINT AS redundant FROM p2 GROUP BY doc_id) SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(w.text, '') END AS text, coalesce(redundant, 0) AS redundant FROM documents d LEFT JOIN w USING (doc_id)",
        "fix_chat": f"""WITH t AS (SELECT qa_id, conversations, unnest(range(len(conversations)))::INT AS turn_no, unnest(conversations) AS turn FROM qa_chat)
            SELECT qa_id, turn_no, turn.role AS role, CASE turn.role WHEN 'user' THEN {_fix_question('turn.content')} WHEN 'assistant' THEN {_fix_answer('turn.content')} ELSE turn.content END AS content FROM t""",
        "chat_jsonl": f"""SELECT qa_id, {json_object([("conversations", "'[' || array_to_string([" + ", ".join(json_object([("role", text_json(q(r))), ("content", text_json(c))]) for r, c in (("system", q(rules.SYSTEM_PROMPT)), ("user", user), ("assistant", "assistant"))) + "], ',') || ']'"), ("segment_id", "segment_id::VARCHAR"), *[(c, text_json(c)) for c in ("dimension", "difficulty", "topic")]])} AS line FROM qa_instructions_robust""",
        "flat_json": f"""SELECT qa_id, {json_object([("system", text_json("system")), ("user", text_json(user)), *[(c, text_json(c)) for c in ("assistant", "topic", "dimension", "difficulty")], ("segment_id", "segment_id::VARCHAR")])} AS line FROM qa_instructions_robust""",
        "topic_extract": f"WITH {topics()} SELECT segment_id, topic FROM t",
        "topic_relation": f"SELECT qa_id, {related('topic', 'assistant')} AS topic FROM qa_instructions_robust WHERE topic IS NOT NULL AND assistant IS NOT NULL",
        "answer_greedy": f"WITH {answer()} SELECT segment_id, answer FROM a",
        "template_expand": f"""WITH {topics()}, {templates()}, r AS (SELECT segment_id, {related('topic', 'content')} AS topic FROM t WHERE content IS NOT NULL)
            SELECT segment_id, dimension, difficulty, topic, CASE WHEN ends_with(template, '？') THEN replace(template, '{{topic}}', topic) ELSE replace(template, '{{topic}}', topic) || '？' END AS {user} FROM r, tm""",
        "repair_lookup_join": f"""WITH {topics()}, {answer()}, g AS (SELECT t.segment_id, {related('t.topic', 't.content')} AS new_topic, answer FROM t JOIN a ON t.segment_id IS NOT DISTINCT FROM a.segment_id WHERE t.content IS NOT NULL),
            x AS (SELECT p.*, new_topic, answer, {needs} AND answer IS NOT NULL AS fixed FROM qa_instructions_robust p LEFT JOIN g USING (segment_id)),
            y AS (SELECT *, replace(CASE dimension {' '.join(f"WHEN {q(d)} THEN {q(rules.TEMPLATES[fs[0]][0])}" for d, fs in rules.DIMENSIONS.items())} ELSE {q(rules.TEMPLATES['medium'][0])} END, '{{topic}}', new_topic) AS nq FROM x)
            SELECT qa_id, CASE WHEN fixed THEN CASE WHEN ends_with(nq, '？') THEN nq ELSE nq || '？' END ELSE {user} END AS {user}, CASE WHEN fixed THEN answer ELSE assistant END AS assistant, CASE WHEN fixed THEN new_topic ELSE topic END AS topic, dimension, segment_id, fixed FROM y""",
        "topic_consistency": """WITH n AS (SELECT segment_id, topic, count(*) AS n FROM qa_instructions_robust WHERE segment_id IS NOT NULL AND topic IS NOT NULL GROUP BY ALL), m AS (SELECT segment_id, topic AS main FROM n QUALIFY row_number() OVER (PARTITION BY segment_id ORDER BY n DESC, topic) = 1)
            SELECT qa_id, CASE WHEN topic <> main AND contains(topic, '责任归属') AND contains(assistant, '自动驾驶') THEN '自动驾驶技术' ELSE topic END AS topic FROM qa_instructions_robust LEFT JOIN m USING (segment_id) WHERE segment_id IS NOT NULL""",
        "line_kind_counts": lines + " SELECT kind, count(*) AS n FROM k GROUP BY kind",
        "terminology_counts": "SELECT doc_id, standard, sum((length(text) - length(replace(text, v, ''))) // length(v))::BIGINT AS n FROM documents, (SELECT standard, unnest(variants) AS v FROM terminology) WHERE contains(text, v) GROUP BY ALL",
        "sentence_split": sents + " SELECT doc_id, para_idx::INT AS para_idx, sent_idx::INT AS sent_idx, sentence FROM s",
        "sentence_dedup": sents
        + ", r AS (SELECT *, length(sentence) > 10 AND row_number() OVER (PARTITION BY doc_id, lower(sentence) ORDER BY para_idx, sent_idx) > 1 AS dup FROM s) SELECT doc_id, para_idx::INT AS para_idx, sent_idx::INT AS sent_idx, sentence, dup FROM r",
        "strip_tags": f"SELECT doc_id, {sub('text', '<[^>]+>')} AS stripped FROM documents",
        "final_formatting": f"SELECT doc_id, {formatted} AS formatted FROM documents",
        "segment_filter": f"SELECT * FROM (SELECT doc_id, unnest(range(len(a)))::INT AS segment_no, {strip(sub('unnest(a)', f'{S}+', ' '))} AS content FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL)) WHERE length(content) > 50",
        "topic_valid": f"SELECT qa_id, coalesce({valid}, false) AS valid FROM qa_instructions_robust",
        "answer_sentences": f"""SELECT segment_id, unnest(range(len(a)))::INT AS sent_idx, unnest(a) AS sentence FROM (
            SELECT segment_id, list_filter(list_transform(regexp_extract_all({clean_gen('content')}, '[^。！？!?;；]*[。！？!?;；]'), lambda x: {strip('x')}), lambda x: x <> '') AS a FROM {segs})""",
        "topic_mode": """WITH t AS (SELECT segment_id, topic, count(*) AS n FROM qa_instructions_robust WHERE segment_id IS NOT NULL AND topic IS NOT NULL GROUP BY ALL)
            SELECT segment_id, topic FROM t QUALIFY row_number() OVER (PARTITION BY segment_id ORDER BY n DESC, topic) = 1""",
        "validate_pairs": f"SELECT qa_id, {needs} AS needs_fix, {sound} AS sound FROM qa_instructions_robust",
        "pair_statistics": """SELECT 'dimension' AS axis, dimension AS "value", count(*) AS n FROM qa_instructions_robust GROUP BY ALL UNION ALL SELECT 'difficulty', difficulty, count(*) FROM qa_instructions_robust GROUP BY ALL
            UNION ALL SELECT 'segments', 'covered', count(DISTINCT segment_id) FROM qa_instructions_robust UNION ALL SELECT 'segments', 'all', count(DISTINCT segment_id) FROM segmented_content""",
        "fix_question": f"SELECT qa_id, {_fix_question()} AS {user} FROM qa_instructions_robust",
        "fix_answer": f"SELECT qa_id, {_fix_answer()} AS assistant FROM qa_instructions_robust",
        "fix_pairs": f"SELECT qa_id, {_fix_question()} AS {user}, {_fix_answer()} AS assistant, {_fix_question()} IS DISTINCT FROM {user} OR {_fix_answer()} IS DISTINCT FROM assistant AS fixed FROM qa_instructions_robust",
        "validate_fixed": f"""WITH f AS (SELECT {_fix_question()} AS q, {_fix_answer()} AS a FROM qa_instructions_robust)
            SELECT count(*) AS total, count(*) FILTER (length(q) >= 10 AND (ends_with(q, '？') OR ends_with(q, '?'))) AS good_questions, count(*) FILTER (length(a) >= 50) AS good_answers,
                   good_questions * 100.0::DOUBLE / total AS good_questions_percent, good_answers * 100.0::DOUBLE / total AS good_answers_percent FROM f""",
        "validate_chat": """WITH f AS (SELECT list_filter(conversations, lambda t: t.role = 'user')[1].content AS q, list_filter(conversations, lambda t: t.role = 'assistant')[1].content AS a FROM qa_chat)
            SELECT count(*) AS total, count(*) FILTER (length(q) >= 10 AND (ends_with(q, '？') OR ends_with(q, '?'))) AS good_questions, count(*) FILTER (length(a) >= 50) AS good_answers,
                   good_questions * 100.0::DOUBLE / total AS good_questions_percent, good_answers * 100.0::DOUBLE / total AS good_answers_percent FROM f""",
        "duplicates": FILES + " SELECT file_ord, qa_id, dup_question, dup_answer FROM files",
        **{name: scored + f" SELECT file_ord, qa_id, {name} FROM scored" for name in _rules()},
        "keyword_set": f"SELECT qa_id, array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(lower(coalesce({user}, '')), '{W}+')), lambda k: k NOT IN ({', '.join(q(s) for s in rules.QUESTION_STOPS)}))), '|') AS keywords FROM qa_instructions_robust",
        "evaluate_pairs": scored + " SELECT file_ord, qa_id, total_score, len(issue_list) AS n_issues, array_to_string(issue_list, '; ') AS issues FROM scored",
        "quality_report": scored + report,
        "issue_counts": scored + f", r AS ({report}) SELECT file_ord, {', '.join(f'sum({c}) OVER (ORDER BY file_ord)::BIGINT AS {c}' for c in COUNTERS)} FROM r",
        "select_threshold": scored + " SELECT file_ord, qa_id, total_score FROM scored WHERE total_score >= 85",
        "select_balanced": balanced + " SELECT * FROM best",
        "page_join": f"SELECT doc_id, array_to_string(list_transform(string_split_regex(text, {q(PAGE)}), lambda x, i: chr(10) || chr(10) || '=== 第 ' || i || ' 页 ===' || chr(10) || chr(10) || {strip('x')}), '') AS text FROM documents WHERE text IS NOT NULL",
        "url_remove_basic": f"WITH t0 AS (SELECT doc_id, text, text AS x0 FROM documents)" + "".join(f", t{i + 1} AS (SELECT *, {sub(f'x{i}', p)} AS x{i + 1} FROM t{i})" for i, p in enumerate(addresses))
        + f" SELECT doc_id, x{len(addresses)} AS text, {' + '.join(f'(length(x{i + 1}) < length(x{i}))::INT' for i in range(len(addresses)))} AS fired FROM t{len(addresses)}",
        "report_digest": scored + f", r AS ({report}) SELECT file_ord, total_pairs, average_score, excellent, question_answer_mismatch, topic_mismatch FROM r",
        "report_json": scored + f", r AS ({report}) SELECT file_ord, " + json_object([("filename", "to_json('file' || file_ord)::VARCHAR"), ("total_pairs", "total_pairs::VARCHAR"), ("average_score", "average_score::VARCHAR"),
            *[(name, json_object([(c, f"{c}::VARCHAR") for c in cs])) for name, cs in (("score_distribution", ("excellent", "good", "fair", "poor")), ("common_issues", COUNTERS))]]) + " AS report FROM r",
        "final_top200": balanced + " SELECT file_ord, qa_id, total_score FROM best ORDER BY total_score DESC, md5(concat_ws('|', 3, file_ord, qa_id)), file_ord, qa_id LIMIT 200",
        "question_sample": f"""WITH {topics()}, {answer()}, {templates()}, g AS (SELECT t.segment_id, {related('t.topic', 't.content')} AS topic, answer FROM t JOIN a ON t.segment_id IS NOT DISTINCT FROM a.segment_id WHERE t.content IS NOT NULL),
            k AS (SELECT segment_id, tm.*, dense_rank() OVER (PARTITION BY segment_id ORDER BY md5(concat_ws('|', 11, segment_id, dimension)), dimension) AS d FROM g, tm),
            k2 AS (SELECT *, row_number() OVER (PARTITION BY segment_id, dimension ORDER BY md5(concat_ws('|', 11, segment_id, dimension, template)), difficulty, tmpl_no) AS n FROM k WHERE d <= 3),
            k3 AS (SELECT *, row_number() OVER (PARTITION BY segment_id, template ORDER BY dim_no, difficulty) AS o FROM k2 WHERE n <= CASE WHEN left(md5(concat_ws('|', 11, segment_id, dim_no)), 1) < '8' THEN 1 ELSE 2 END)
            SELECT segment_id, dimension, difficulty, topic, CASE WHEN ends_with(template, '？') THEN replace(template, '{{topic}}', topic) ELSE replace(template, '{{topic}}', topic) || '？' END AS {user}, answer AS assistant FROM k3 JOIN g USING (segment_id) WHERE o = 1""",
        "topic_top10": "SELECT coalesce(topic, '未知主题') AS topic, count(*) AS n FROM qa_instructions_robust GROUP BY ALL ORDER BY n DESC, topic LIMIT 10",
        "dimension_dist": "SELECT coalesce(dimension, '未知维度') AS dimension, count(*) AS n FROM qa_instructions_robust GROUP BY ALL",
    }
