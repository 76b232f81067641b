"""The core's queries in SQL, written for themselves, to compare results with."""

from __future__ import annotations

from quirework.functions import text as T
from quirework.operators import generation, quality, routing, samples


def q(pattern: str) -> str:
    """A pattern as an SQL string."""
    return "'" + pattern.replace("'", "''") + "'"


def clean(c: str) -> str:
    return rf"trim(regexp_replace(coalesce({c}, ''), '[\s\p{{Z}}\x0b\x1c-\x1f\x{{85}}]+', ' ', 'g'))"


def hit(c: str, pattern: str) -> str:
    return f"regexp_matches({c}, {q(pattern)})"


def words(c: str, ws: tuple[str, ...]) -> str:
    return hit(c, "|".join(ws))


def names(ws) -> str:
    return ", ".join(q(w) for w in ws)


BLOCKS = """
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY journal_id, page_index, block_uid ORDER BY ingested_at) AS rn FROM journal_blocks) WHERE rn = 1),
v AS (SELECT *, len(bbox) = 4 AND bbox[3] > bbox[1] AND bbox[4] > bbox[2] AS ok FROM d),
b AS (SELECT * EXCLUDE (ok, rn), CASE WHEN ok THEN bbox[1] END AS x0, CASE WHEN ok THEN bbox[2] END AS y0, CASE WHEN ok THEN bbox[3] END AS x1, CASE WHEN ok THEN bbox[4] END AS y1,
  CASE WHEN ok THEN bbox[2] ELSE reading_order::DOUBLE END AS top, CASE WHEN ok THEN bbox[1] ELSE 0.0 END AS "left" FROM v)"""
PAGES = "p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY journal_id, page_index ORDER BY page_uid, ingested_at) AS rn FROM journal_pages) WHERE rn = 1)"
RO = "coalesce(nullif(reading_order, 0), 9999)"
KIND = f"CASE WHEN {hit('t', T.FIGURE_CAPTION)} THEN 'figure_caption' WHEN {hit('t', T.TABLE_CAPTION)} THEN 'table_caption' ELSE '' END"
HEADING = f"(t <> '' AND length(t) <= 80 AND NOT {hit('t', T.HEADING_SKIP)} AND ({' OR '.join(hit('t', h) for h in T.HEADINGS)}))"

ROLES = f"""
WITH {BLOCKS},
h AS (SELECT *, {clean("text")} AS t, coalesce(trunc(max(y1) OVER (PARTITION BY journal_id, page_index))::INT, 0) AS height FROM b)
SELECT block_uid, CASE
  WHEN {hit("t", T.STRONG_NOISE)} THEN 'watermark'
  WHEN block_type = 'header' THEN 'journal_header' WHEN block_type = 'footer' THEN 'footer'
  WHEN block_type = 'page_number' OR {hit("t", T.PAGE_NUMBER)} THEN 'page_number'
  WHEN y0 IS NOT NULL AND height > 0 AND y0 <= height * 0.05::DOUBLE AND length(t) < 80 THEN 'journal_header'
  WHEN y1 IS NOT NULL AND height > 0 AND y1 >= height * 0.95::DOUBLE AND length(t) < 80 THEN 'footer'
  WHEN {KIND} <> '' THEN {KIND}
  WHEN block_type = 'formula' THEN 'formula'
  WHEN {hit("t", r"^摘\s*要")} OR starts_with(lower(t), 'abstract') THEN 'abstract'
  WHEN starts_with(t, '关键词') OR {hit("t", r"(?i)^key\s*words?")} THEN 'keywords'
  WHEN starts_with(t, 'http://') OR starts_with(t, 'https://') THEN 'journal_header'
  WHEN contains(upper(t), 'DOI') OR contains(t, '中图分类号') OR contains(t, '文献标识码') OR contains(t, '收稿日期') THEN 'journal_header'
  WHEN starts_with(t, '\\* 通信作者') OR starts_with(t, '* 通信作者') OR starts_with(t, '通信作者') OR starts_with(t, '引用格式') THEN 'footer'
  WHEN {hit("t", T.REFERENCE)} OR contains(t, '参考文献') THEN 'reference'
  WHEN {HEADING} OR block_type IN ('title', 'section_title') THEN CASE WHEN page_index = 1 AND length(t) > 8 AND NOT {hit("t", r"^\p{Nd}")} THEN 'article_title' ELSE 'section_heading' END
  WHEN t <> '' THEN 'body' ELSE 'unknown' END AS role FROM h
"""

# Columns by counting bins, as the projection is defined; the engine has it from the intervals.
BANDS = f"""
{BLOCKS},
w AS (SELECT journal_id, page_index, x0, x1, trunc(max(x1) OVER (PARTITION BY journal_id, page_index))::DOUBLE AS width FROM b),
r AS (SELECT *, unnest([0.45::DOUBLE, 0.55, 0.65, 0.75, 0.85]) AS ratio FROM w WHERE x0 IS NOT NULL AND width > 0),
n AS (SELECT *, greatest(0, least(399, trunc(x0 / width * 400)::INT)) AS lo FROM r WHERE x1 - x0 < width * ratio),
m AS (SELECT *, greatest(lo + 1, least(400, ceil(x1 / width * 400)::INT)) AS hi FROM n),
bins AS (SELECT DISTINCT journal_id, page_index, ratio, width, unnest(range(lo, hi)) AS bin FROM m),
g AS (SELECT *, bin - coalesce(lag(bin) OVER (PARTITION BY journal_id, page_index, ratio ORDER BY bin), -1000) AS gap FROM bins),
runs AS (SELECT *, sum(CASE WHEN gap > 5 THEN 1 ELSE 0 END) OVER (PARTITION BY journal_id, page_index, ratio ORDER BY bin) AS run FROM g),
ends0 AS (SELECT journal_id, page_index, ratio, width, run, min(bin) AS lo, max(bin) + 1 AS hi FROM runs GROUP BY ALL),
ends AS (SELECT *, max(run) OVER (PARTITION BY journal_id, page_index, ratio) AS last FROM ends0),
kept AS (SELECT journal_id, page_index, ratio, width, lo, CASE WHEN run = last AND 400 - hi < 5 THEN 400 ELSE hi END AS hi FROM ends WHERE (CASE WHEN run = last AND 400 - hi < 5 THEN 400 ELSE hi END - lo) / 400.0::DOUBLE >= 0.06),
few AS (SELECT journal_id, page_index, ratio, count(*) AS n FROM kept GROUP BY ALL HAVING count(*) <= 6),
best AS (SELECT journal_id, page_index, arg_min(ratio, (-n, ratio)) AS ratio FROM few GROUP BY ALL),
bands AS (SELECT journal_id, page_index, (row_number() OVER (PARTITION BY journal_id, page_index ORDER BY lo) - 1)::INT AS band, lo / 400.0::DOUBLE * width AS lo, hi / 400.0::DOUBLE * width AS hi FROM kept JOIN best USING (journal_id, page_index, ratio))"""

ASSIGNED = f"""
{BANDS},
ext AS (SELECT journal_id, page_index, min(x0) AS lo, max(x1) AS hi FROM b GROUP BY ALL),
allb AS (SELECT * FROM bands UNION ALL SELECT journal_id, page_index, 0, lo, hi FROM ext WHERE hi >= 1 AND (journal_id, page_index) NOT IN (SELECT (journal_id, page_index) FROM bands)),
tot AS (SELECT journal_id, page_index, count(*) AS total FROM allb GROUP BY ALL),
j AS (SELECT b.block_uid, band, total, least(x1, allb.hi) - greatest(x0, allb.lo) > least(greatest(1e-6::DOUBLE, x1 - x0), allb.hi - allb.lo) * 0.35::DOUBLE AS over_it, abs((x0 + x1) / 2 - (allb.lo + allb.hi) / 2.0::DOUBLE) AS d
  FROM b JOIN allb USING (journal_id, page_index) JOIN tot USING (journal_id, page_index) WHERE x0 IS NOT NULL),
k AS (SELECT block_uid, max(total) AS total, count(*) FILTER (over_it) AS n, min(band) FILTER (over_it) AS one, arg_min(band, (d, band)) AS near FROM j GROUP BY ALL),
a AS (SELECT b.*, CASE WHEN k.block_uid IS NULL OR n > 1 THEN -1 WHEN n = 1 THEN one ELSE near END AS ci, n, total FROM b LEFT JOIN k USING (block_uid)),
asg AS (SELECT *, CASE WHEN total IS NULL THEN 'unknown' WHEN n > 1 THEN 'full_width' WHEN total = 1 THEN 'single' WHEN total = 2 THEN CASE WHEN ci = 0 THEN 'left' ELSE 'right' END ELSE 'col' || (ci + 1) END AS col_label2,
  CASE WHEN n > 1 THEN CASE WHEN n >= total THEN 'full_width' ELSE 'cross_column' END ELSE 'single_column' END AS span FROM a)"""

ORDERED = f"""
{ASSIGNED},
c AS (SELECT * FROM asg WHERE NOT (coalesce(semantic_role, 'unknown') = 'watermark' OR (coalesce(semantic_role, 'unknown') IN ('journal_header', 'footer', 'page_number', 'unknown') AND {clean("text")} = ''))),
mu AS (SELECT journal_id, page_index, count(DISTINCT CASE WHEN ci >= 0 THEN ci END) >= 2 AS multi FROM c GROUP BY ALL),
s AS (SELECT c.*, multi, (SELECT count(*) FROM c x WHERE x.journal_id = c.journal_id AND x.page_index = c.page_index AND x.ci < 0 AND x.top <= c.top) AS above,
  row_number() OVER (PARTITION BY c.journal_id, c.page_index, c.ci ORDER BY top, "left", reading_order, block_ordinal) - 1 AS k FROM c JOIN mu USING (journal_id, page_index)),
o AS (SELECT *, row_number() OVER (PARTITION BY journal_id, page_index ORDER BY CASE WHEN NOT multi THEN 0 WHEN ci < 0 THEN k ELSE above END, CASE WHEN multi AND ci < 0 THEN 1 ELSE 0 END, CASE WHEN multi THEN ci ELSE 0 END, top, "left", CASE WHEN multi THEN 0 ELSE reading_order END, block_ordinal)::INT AS new_order FROM s)"""

SIGNALS = " + ".join(f"{hit('t', p)}::INT" for p in T.NOISE_SIGNALS)
PAGE_TYPES = f"""
WITH {BLOCKS},
g AS (SELECT journal_id, page_index, string_agg({clean("text")}, chr(10) ORDER BY {RO}, block_ordinal) AS lines, count(*) AS n_blocks, bool_or(coalesce(semantic_role = 'article_title', false)) AS has_title FROM b GROUP BY ALL),
c AS (SELECT *, {clean("lines")} AS t FROM g),
s AS (SELECT *, {SIGNALS} AS n_signals, {hit("t", r"(?i)(摘\s*要|摘要|Abstract)")} AS abs_, {hit("t", r"(?i)(关键词|Key\s*words?)")} AS key_ FROM c)
SELECT journal_id, page_index, length(t) AS n_chars, n_signals, CASE
  WHEN length(t) < 8 AND n_blocks = 0 THEN 'blank' WHEN length(t) < 20 AND n_blocks > 0 THEN 'scan_only'
  WHEN {hit("t", r"(?i)(目录|目次|CONTENTS)")} THEN 'table_of_contents'
  WHEN {hit("t", r"(?i)(编委会|主\s*编|副主编|顾问|Editorial\s+Board)")} THEN 'editorial_board'
  WHEN {hit("t", r"(?i)(^|\s)(参考文献|References)\s*$")} OR starts_with(t, '参考文献') THEN 'references'
  WHEN {hit("t", T.STRONG_NOISE)} OR n_signals >= 4 OR (n_signals >= 2 AND length(t) <= 1200) THEN 'advertisement_or_notice'
  WHEN page_index = 1 AND NOT {hit("t", r"(?i)(摘要|关键词|Abstract|Key\s*words?)")} AND {hit("t", r"(?i)(主管|主办|出版|ISSN|CN\s*\p{Nd}+|第\s*\p{Nd}+\s*卷)")} THEN 'cover'
  WHEN abs_ AND key_ AND page_index > 1 AND {hit("t", r"(?i)(参考文献|作者简介|References)")} THEN 'article_body'
  WHEN (abs_ AND key_) OR (has_title AND abs_) THEN 'article_first_page'
  WHEN length(t) >= 80 THEN 'article_body' ELSE 'unknown' END AS type FROM s
"""

VISIBLE = f"""
{BLOCKS}, {PAGES},
vis AS (SELECT b.*, p.page_type, p.article_id, {clean("CASE WHEN coalesce(markdown, '') <> '' THEN markdown ELSE text END")} AS shown FROM b JOIN p USING (journal_id, page_index)
  WHERE coalesce(semantic_role, '') NOT IN ('journal_header', 'footer', 'page_number', 'watermark', 'reference') AND coalesce(p.page_type, '') NOT IN ('cover', 'editorial_board', 'table_of_contents', 'advertisement_or_notice', 'blank', 'references')),
vb AS (SELECT * FROM vis WHERE shown <> '')"""

PARAS = f"""
{VISIBLE},
pr AS (SELECT *, CASE WHEN semantic_role IN ('article_title', 'abstract', 'keywords', 'section_heading', 'figure_caption', 'table_caption', 'formula') THEN semantic_role WHEN block_type IN ('table', 'figure', 'formula') THEN block_type ELSE 'body' END AS prole FROM vb),
lg AS (SELECT *, lag(shown) OVER art AS prev, lag(prole <> 'body') OVER art AS prevspecial, coalesce(max((semantic_role = 'abstract')::INT) OVER (PARTITION BY journal_id, article_id, page_index ORDER BY {RO}, block_ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
  FROM pr WINDOW art AS (PARTITION BY journal_id, article_id ORDER BY page_index, {RO}, block_ordinal)),
nw AS (SELECT *, prev IS NULL OR (coalesce(page_type = 'article_first_page', false) AND seen = 0) OR prole <> 'body' OR prevspecial OR {hit("shown", T.LIST_ITEM)} OR {hit("prev", T.PARAGRAPH_END)} AS new FROM lg),
sq AS (SELECT *, sum(new::INT) OVER (PARTITION BY journal_id, article_id ORDER BY page_index, {RO}, block_ordinal) AS seq,
  CASE WHEN new OR contains({q(T.NO_SPACE_BEFORE)}, left(shown, 1)) THEN '' WHEN {hit("prev", "[A-Za-z0-9]$")} AND {hit("shown", "^[A-Za-z0-9]")} THEN ' ' ELSE '' END AS glue FROM nw),
pg AS (SELECT journal_id, article_id, seq, min(page_index) AS start_page, max(page_index) AS end_page, arg_min(prole, (page_index, {RO}, block_ordinal)) AS role, count(*)::INT AS n_blocks, string_agg(glue || shown, '' ORDER BY page_index, {RO}, block_ordinal) AS text FROM sq GROUP BY ALL),
paras AS (SELECT journal_id, article_id, start_page, row_number() OVER (PARTITION BY journal_id, article_id, start_page ORDER BY seq)::INT AS paragraph, end_page, role, n_blocks, text FROM pg)"""

SPANS = f"""
{PAGES},
st AS (SELECT journal_id, page_index, page_type, max(CASE WHEN page_type = 'article_first_page' THEN page_index END) OVER (PARTITION BY journal_id ORDER BY page_index) AS start, count(CASE WHEN page_type = 'article_first_page' THEN 1 END) OVER (PARTITION BY journal_id) AS n FROM p),
spans AS (SELECT journal_id, start AS start_page, max(CASE WHEN coalesce(page_type, '') NOT IN ('references', 'table_of_contents', 'editorial_board', 'cover', 'blank') OR page_index = start THEN page_index END) AS end_page FROM st WHERE start IS NOT NULL GROUP BY ALL
  UNION ALL SELECT journal_id, min(page_index), max(page_index) FROM st WHERE n = 0 AND page_type IN ('article_first_page', 'article_body') GROUP BY ALL)"""

LOW = "('cover', 'editorial_board', 'table_of_contents', 'references', 'advertisement_or_notice', 'blank')"
PAGE_TEXT = f"{clean('CASE WHEN ' + clean('visible_text') + chr(32) + '<> ' + q('') + ' THEN visible_text ELSE full_text END')}"
TEXTS = f"{PAGES}, pt AS (SELECT *, {PAGE_TEXT} AS t FROM p), tr AS (SELECT *, t <> '' AND coalesce(page_type, '') NOT IN {LOW} AS ok FROM pt)"

SECTIONS = f"""
{BLOCKS},
sc AS (SELECT *, {clean("text")} AS t, sum(coalesce((semantic_role = 'section_heading')::INT, 0)) OVER (PARTITION BY journal_id, page_index ORDER BY {RO}, block_ordinal) AS sec FROM b),
sg AS (SELECT journal_id, page_index, sec, max(block_uid) FILTER (semantic_role = 'section_heading') AS heading_uid, max(t) FILTER (semantic_role = 'section_heading') AS heading,
  list(t ORDER BY {RO}, block_ordinal) FILTER (coalesce(semantic_role, '') NOT IN ('section_heading', 'journal_header', 'footer', 'page_number', 'reference') AND t <> '') AS parts FROM sc WHERE sec > 0 GROUP BY ALL),
secs AS (SELECT journal_id, page_index, heading_uid, coalesce(len(parts), 0)::INT AS n_blocks, coalesce(length(array_to_string(parts, ' ')), 0)::INT AS n_chars FROM sg WHERE heading <> '')"""

FORMAT = f"CASE WHEN task_type IN ({names(samples.FORMATS['pt'])}) THEN 'pt' WHEN task_type IN ({names(samples.FORMATS['sharegpt'])}) THEN 'sharegpt' WHEN task_type IN ({names(samples.FORMATS['alpaca'])}) THEN 'alpaca' ELSE 'unknown' END"
CORPUS = "CASE WHEN coalesce(output_payload.text, '') <> '' THEN output_payload.text ELSE coalesce(text, '') END"
ANSWER = f"""CASE WHEN coalesce(task_type, '') = '{samples.CORPUS}' THEN {clean(CORPUS)} WHEN {clean("answer")} <> '' THEN {clean("answer")} ELSE trim(concat_ws(' ', nullif({clean("output_payload.text")}, ''), nullif({clean("output_payload.summary")}, ''))) END"""
QUESTION = clean("CASE WHEN coalesce(instruction, '') <> '' THEN instruction ELSE question END")


def _run(c: str) -> str:
    """Nine equal characters in a row, without a back reference: nine times a character, for every character that is there."""
    return f"list_bool_or(list_transform(list_distinct(string_split({c}, '')), lambda x: x <> '' AND contains({c}, repeat(x, 9))))"


def _common(c: str, on: str) -> str:
    ratio = rf"(CASE WHEN length(regexp_replace({c}, '[\s\p{{Z}}]+', '', 'g')) = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE - length(regexp_replace(regexp_replace({c}, '[\s\p{{Z}}]+', '', 'g'), {q('[^一-鿿A-Za-z0-9，。；：？！、,.!?;:()\\[\\]{}<>《》“”' + chr(34) + chr(39) + '/%+\\-=—_·&~]')}, '', 'g'))::DOUBLE / length(regexp_replace({c}, '[\s\p{{Z}}]+', '', 'g')) END)"
    on = f"{on} AND {c} <> ''"
    moji = T.MOJIBAKE
    return "".join(
        f" - CASE WHEN {on} AND {cond} THEN {by}::DOUBLE ELSE 0.0::DOUBLE END"
        for cond, by in ((hit(c, moji), 0.45), (f"coalesce({_run(c)}, false)", 0.25), (f"{ratio} > 0.32::DOUBLE", 0.25), (f"contains({c}, '```')", 0.15))
    )


def _minus(cond: str, by: float) -> str:
    return f" - CASE WHEN {cond} THEN {by}::DOUBLE ELSE 0.0::DOUBLE END"


QUALITY = f"""
WITH s AS (SELECT ordinal, id, {FORMAT} AS format, {QUESTION} AS q, {ANSWER} AS a FROM samples),
r AS (SELECT *, 1.0::DOUBLE{_minus("format <> 'pt' AND q = ''", 0.45)}{_minus("format <> 'pt' AND q <> '' AND length(q) < 4", 0.25)}{_common("q", "format <> 'pt'")}{_minus("format <> 'pt' AND " + hit("q", r"^[{\[]"), 0.25)}
{_minus("a = ''", 0.45)}{_minus("a <> '' AND length(a) < 8", 0.25)}{_common("a", "true")}{_minus("format IN ('sharegpt', 'alpaca') AND " + hit("a", r"^[{\[]"), 0.35)}{_minus("format IN ('sharegpt', 'alpaca') AND " + hit("a", samples.INTERNAL), 0.35)}
{_minus("format IN ('sharegpt', 'alpaca') AND " + hit("a", r"(?i)\b(summary|text)\b\s*[:：]"), 0.35)}{_minus("format = 'pt' AND " + hit("a", samples.TRAINING), 0.35)} AS raw FROM s)
SELECT ordinal, id, format, round_even(greatest(0.0::DOUBLE, least(1.0::DOUBLE, raw)), 3) AS score, raw >= 0.72::DOUBLE AS passed FROM r
"""

TERMS = r"[A-Za-z][A-Za-z0-9_/\-]{1,30}|[一-鿿A-Za-z0-9]{2,18}"


def _terms(c: str) -> str:
    """Words in the order of their first appearance, the first 120."""
    return f"list_slice(list_filter(regexp_extract_all({c}, {q(TERMS)}), lambda x, i: NOT list_contains([{names(samples.STOPWORDS)}], x) AND list_position(regexp_extract_all({c}, {q(TERMS)}), x) = i), 1, 120)"


def _safe(c: str, default: str) -> str:
    s = rf"""regexp_replace(regexp_replace(regexp_replace(trim(coalesce({c}, '')), '[<>:"/\\\\|?*\x00-\x1f]+', '_', 'g'), '[\s\p{{Z}}]+', '_', 'g'), '^[._ ]+|[._ ]+$', '', 'g')"""
    return f"CASE WHEN {s} = '' THEN {q(default)} ELSE {s} END"


VISUAL = "|".join(quality.VISUAL_TERMS)
QLT3 = f"""
WITH s AS (SELECT ordinal, {FORMAT} AS f, {QUESTION} AS q, {ANSWER} AS a, coalesce(output_payload.text, '') <> '' OR coalesce(output_payload.summary, '') <> '' AS payload FROM samples),
t AS (SELECT *, {_terms("a")} AS w FROM s WHERE f IN ('sharegpt', 'alpaca')),
r AS (SELECT ordinal, 1.0::DOUBLE{_minus("q = '' OR a = ''", 0.55)}{_minus("NOT payload", 0.35)}{_minus("(" + hit("a", quality.UNUSABLE) + " OR " + hit("a", quality.AVAILABLE) + ") AND len(list_slice(w, 1, 20)) < 4", 0.45)}{_minus("len(w) < 2", 0.25)} AS raw FROM t)
SELECT ordinal, round_even(greatest(0.0::DOUBLE, least(1.0::DOUBLE, raw)), 3) AS score, raw >= 0.70::DOUBLE AS passed FROM r"""
QLT4 = f"""
WITH s AS (SELECT ordinal, task_type, coalesce(len(images), 0) AS n, {QUESTION} AS q FROM samples WHERE {FORMAT} = 'sharegpt'),
r AS (SELECT ordinal, 1.0::DOUBLE{_minus("n < 1", 0.55)}{_minus("NOT " + hit("lower(q)", VISUAL), 0.35)}{_minus(f"task_type = '{quality.FIGURE_TASK}' AND NOT " + hit("q", quality.OBJECT_WORDS), 0.25)}{_minus(f"task_type IN ({names(quality.LAYOUT_TASKS)}) AND NOT " + hit("q", quality.LAYOUT_WORDS), 0.25)}{_minus(f"task_type = '{quality.CROSS_TASK}' AND NOT " + hit("q", quality.CROSS_WORDS), 0.25)} AS raw FROM s)
SELECT ordinal, round_even(greatest(0.0::DOUBLE, least(1.0::DOUBLE, raw)), 3) AS score, raw >= 0.60::DOUBLE AS passed FROM r"""

def _sentences(c: str) -> str:
    return rf"list_filter(list_transform(string_split(regexp_replace({c}, '([。！？；;.!?])\s*', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')"


def _with(ws: tuple[str, ...], limit: int = 4) -> str:
    """The picked sentences of a column s16 of sixteen."""
    hits = f"list_filter(s16, lambda x: {words('x', ws)})"
    return f"list_transform(list_slice(CASE WHEN len({hits}) > 0 THEN {hits} ELSE s16 END, 1, {limit}), lambda x: rtrim(left(x, 260)))"


SENT = f"{TEXTS}, sn AS (SELECT *, list_slice({_sentences('t')}, 1, 16) AS s16 FROM tr)"

ORACLES: dict[str, str] = {
    "valid_boxes": f'WITH {BLOCKS} SELECT block_uid, top, "left", coalesce((x1 - x0) * (y1 - y0), 0.0) AS area FROM b',
    "page_sizes": f"WITH {BLOCKS} SELECT journal_id, page_index, coalesce(trunc(max(x1))::INT, 0) AS width, coalesce(trunc(max(y1))::INT, 0) AS height, count(*) AS n_blocks FROM b GROUP BY ALL",
    "block_roles": ROLES,
    "column_bands": f"WITH {BANDS} SELECT journal_id, page_index, band, lo, hi FROM bands",
    "column_assignment": f"WITH {ASSIGNED} SELECT block_uid, ci AS col_index, col_label2 AS col_label, span FROM asg",
    "column_modes": f"""WITH {ASSIGNED}, mo AS (SELECT journal_id, page_index, count(DISTINCT CASE WHEN ci >= 0 THEN ci END) AS pop, count(*) FILTER (span <> 'single_column') AS spanning FROM asg GROUP BY ALL)
SELECT journal_id, page_index, CASE WHEN pop >= 2 THEN CASE WHEN spanning > 0 THEN 'mixed_full_width_and_' ELSE '' END || ['single', 'two', 'three', 'four', 'five', 'six'][pop] || '_column' WHEN spanning > 0 AND pop > 0 THEN 'mixed_full_width_and_single_column' WHEN spanning > 0 THEN 'full_width' WHEN pop > 0 THEN 'single_column' ELSE 'unknown' END AS mode,
CASE WHEN pop >= 1 THEN pop ELSE 0 END::INT AS n_columns FROM mo""",
    "reading_order": f"WITH {ORDERED} SELECT block_uid, new_order FROM o",
    "reading_order_check": f"""WITH {ORDERED}, bd AS (SELECT *, sum((ci < 0)::INT) OVER (PARTITION BY journal_id, page_index ORDER BY new_order) AS band FROM o),
k2 AS (SELECT *, max(CASE WHEN ci >= 0 THEN ci END) OVER (PARTITION BY journal_id, page_index, band ORDER BY new_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM bd)
SELECT journal_id, page_index, NOT bool_or(ci >= 0 AND ci < coalesce(high, -1)) AND count(DISTINCT CASE WHEN ci >= 0 THEN ci END) >= 2 AS ok FROM k2 GROUP BY ALL""",
    "page_types": PAGE_TYPES,
    "visible_blocks": f"WITH {VISIBLE} SELECT block_uid, length(shown) AS n_chars FROM vb",
    "paragraphs": f"WITH {PARAS} SELECT * FROM paras",
    "page_texts": f"WITH {PARAS} SELECT journal_id, start_page AS page_index, count(*)::INT AS n_paragraphs, string_agg(text, chr(10) || chr(10) ORDER BY article_id, paragraph) AS full_text FROM paras GROUP BY ALL",
    "article_spans": f"WITH {SPANS} SELECT * FROM spans",
    "page_articles": f"""WITH {SPANS}, r AS (SELECT p.journal_id, p.page_index, max(start_page) AS start_page, arg_max(end_page, start_page) AS end_page FROM p LEFT JOIN spans s ON s.journal_id = p.journal_id AND p.page_index BETWEEN s.start_page AND s.end_page GROUP BY ALL)
SELECT *, CASE WHEN start_page IS NULL THEN 'unknown' WHEN page_index = start_page THEN 'first_page' WHEN page_index = end_page THEN 'last_page' ELSE 'body' END AS role FROM r""",
    "page_neighbours": f"WITH {PAGES} SELECT journal_id, page_index, CASE WHEN page_index > 1 THEN page_index - 1 END AS before, CASE WHEN page_index < max(page_index) OVER (PARTITION BY journal_id) THEN page_index + 1 END AS after FROM p",
    "nearest_captions": f"""WITH {BLOCKS}, x AS (SELECT v.block_uid, c.block_uid AS caption_uid, c.block_ordinal, greatest(0.0, least(v.x1, c.x1) - greatest(v.x0, c.x0)) / greatest(1.0, least(v.x1 - v.x0, c.x1 - c.x0)) AS over_it, least(abs(c.y0 - v.y1), abs(v.y0 - c.y1)) AS gap
FROM b v JOIN b c USING (journal_id, page_index) WHERE v.block_type IN ('figure', 'table', 'formula') AND v.x0 IS NOT NULL AND c.x0 IS NOT NULL AND c.semantic_role IN ('figure_caption', 'table_caption') AND c.block_uid <> v.block_uid AND {clean("c.text")} <> '')
SELECT block_uid, caption_uid, rank FROM (SELECT *, row_number() OVER (PARTITION BY block_uid ORDER BY gap, block_ordinal, caption_uid)::INT AS rank FROM x WHERE over_it >= 0.2) WHERE rank <= 2""",
    "same_label_blocks": f"""WITH {BLOCKS}, t AS (SELECT *, {clean("text")} AS t FROM b), l AS (SELECT *, lower(regexp_replace(regexp_extract(t, {q(T.LABEL)}, 1), '\\s+', '', 'g')) AS label FROM t WHERE block_type IN ('figure', 'table', 'formula'))
SELECT block_uid, label, other_uid, rank FROM (SELECT l.block_uid, l.label, t.block_uid AS other_uid, row_number() OVER (PARTITION BY l.block_uid ORDER BY t.block_ordinal, t.block_uid)::INT AS rank FROM l JOIN t USING (journal_id, page_index) WHERE l.label <> '' AND l.block_uid <> t.block_uid AND contains(lower(regexp_replace(t.t, '\\s+', '', 'g')), l.label)) WHERE rank <= 8""",
    "visual_links": f"""WITH {BLOCKS}, t AS (SELECT *, {clean("text")} AS t, trim(regexp_extract({clean("text")}, {q(T.LABEL)}, 1)) AS lab FROM b),
x AS (SELECT v.block_uid, c.block_uid AS cu, c.block_id AS cid, c.lab, c.block_ordinal, least(abs(c.y0 - v.y1), abs(v.y0 - c.y1)) AS gap FROM t v JOIN t c USING (journal_id, page_index) WHERE v.block_type IN ('figure', 'table', 'formula') AND v.x0 IS NOT NULL AND c.x0 IS NOT NULL AND c.semantic_role IN ('figure_caption', 'table_caption') AND c.block_uid <> v.block_uid AND c.t <> ''
  AND greatest(0.0, least(v.x1, c.x1) - greatest(v.x0, c.x0)) / greatest(1.0, least(v.x1 - v.x0, c.x1 - c.x0)) >= 0.2),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY block_uid ORDER BY gap, block_ordinal, cu) AS rank FROM x) WHERE rank <= 2),
g AS (SELECT block_uid, string_agg(cid, '|' ORDER BY rank) AS captions, arg_min(lab, rank) FILTER (lab <> '') AS lab FROM k GROUP BY ALL),
vl AS (SELECT t.journal_id, t.page_index, t.block_uid, coalesce(g.lab, t.lab) AS label, coalesce(captions, '') AS captions FROM t LEFT JOIN g USING (block_uid) WHERE t.block_type IN ('figure', 'table', 'formula')),
r AS (SELECT vl.block_uid, t.block_id, row_number() OVER (PARTITION BY vl.block_uid ORDER BY t.block_ordinal, t.block_uid) AS n FROM vl JOIN t USING (journal_id, page_index) WHERE label <> '' AND vl.block_uid <> t.block_uid AND contains(lower(regexp_replace(t.t, '\\s+', '', 'g')), lower(regexp_replace(label, '\\s+', '', 'g'))) AND NOT EXISTS (SELECT 1 FROM k WHERE k.block_uid = vl.block_uid AND k.cu = t.block_uid)),
rg AS (SELECT block_uid, string_agg(block_id, '|' ORDER BY n) AS related FROM r WHERE n <= 8 GROUP BY ALL)
SELECT vl.block_uid, label, captions, coalesce(related, '') AS related FROM vl LEFT JOIN rg USING (block_uid)""",
    "barriers": f"""WITH {BLOCKS}, a AS (SELECT *, coalesce(lag(y1) OVER (PARTITION BY journal_id, page_index ORDER BY y0, {RO}, block_ordinal), '-Infinity'::DOUBLE) AS aft FROM b WHERE block_type IN ('figure', 'table', 'formula') AND column_label = 'full_width' AND span_kind IN ('full_width', 'cross_column') AND x0 IS NOT NULL)
SELECT a.block_uid, count(*) FILTER (t.column_label = 'left') AS n_left, count(*) FILTER (t.column_label = 'right') AS n_right FROM a LEFT JOIN b t ON t.journal_id = a.journal_id AND t.page_index = a.page_index AND coalesce(t.semantic_role, '') NOT IN ('journal_header', 'footer', 'page_number', 'reference', 'unknown')
AND coalesce(t.y0, coalesce(nullif(t.reading_order, 0), 9999)::DOUBLE) >= a.aft AND coalesce(t.y0, coalesce(nullif(t.reading_order, 0), 9999)::DOUBLE) < a.y0 GROUP BY a.block_uid""",
    "crop_boxes": rf"""WITH {BLOCKS} SELECT block_uid, trunc(x1 - x0)::INT >= 28 AND trunc(y1 - y0)::INT >= 32 AND trunc(x1 - x0)::INT * trunc(y1 - y0)::INT >= 3000 AND coalesce(block_type, '') NOT IN ('header', 'footer', 'page_number', 'unknown') AND length(regexp_replace(coalesce(text, ''), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')) >= 10 AS kept FROM b WHERE x0 IS NOT NULL""",
    "uncertainty_notes": f"""WITH {ASSIGNED}, mo AS (SELECT journal_id, page_index, count(DISTINCT CASE WHEN ci >= 0 THEN ci END) = 2 AS two, bool_or(block_type IN ('figure', 'table', 'formula') AND col_label2 = 'full_width') AS wide FROM asg GROUP BY ALL)
SELECT journal_id, page_index, CASE WHEN two AND coalesce(wide, false) THEN 2 WHEN two THEN 1 ELSE 0 END AS n_notes FROM mo""",
    "truncated_texts": rf"""WITH {PAGES}, s AS (SELECT page_uid, rtrim(left({clean("full_text")}, 180)) AS short, regexp_replace(coalesce(full_text, ''), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') AS t FROM p), c AS (SELECT *, regexp_replace(left(t, 400), '[\s\p{{Z}}]+$', '') AS c FROM s),
k AS (SELECT *, length(c) - length(regexp_extract(c, '([^
。]*)\z', 1)) AS brk FROM c) SELECT page_uid, short, CASE WHEN length(t) <= 400 THEN t WHEN brk - 1 > 200 THEN regexp_replace(left(c, brk), '[\s\p{{Z}}]+$', '') ELSE c END AS cut FROM k""",
    "visual_containment": f"""WITH {BLOCKS}, a AS (SELECT *, (x1 - x0) * (y1 - y0) AS area FROM b WHERE x0 IS NOT NULL)
SELECT a.block_uid, coalesce(min(CASE WHEN greatest(0.0, least(a.x1, v.x1) - greatest(a.x0, v.x0)) * greatest(0.0, least(a.y1, v.y1) - greatest(a.y0, v.y0)) / a.area >= 0.9 THEN a.area / v.area END), 1.0) >= 0.75 AS kept
FROM a LEFT JOIN a v ON v.journal_id = a.journal_id AND v.page_index = a.page_index AND v.block_type IN ('figure', 'table', 'formula') AND v.block_uid <> a.block_uid AND v.area > a.area GROUP BY a.block_uid""",
    "page_jobs": f"""WITH {TEXTS} SELECT journal_id, page_index, 'page_to_journal_layout_description' AS task_type FROM tr WHERE coalesce(page_type, '') NOT IN ('blank', 'advertisement_or_notice')
UNION ALL SELECT journal_id, page_index, 'article_metadata_extraction' FROM tr WHERE page_type = 'article_first_page'
UNION ALL SELECT journal_id, page_index, 'two_column_reading_order_reconstruction' FROM tr WHERE {hit("column_mode", "(two|three|four|five|six)_column")} OR len(uncertainty_notes) > 0
UNION ALL SELECT journal_id, page_index, 'method_experiment_condition_extraction' FROM tr WHERE ok AND {words("t", routing.METHOD)}
UNION ALL SELECT journal_id, page_index, 'evidence_to_claim_chain' FROM tr WHERE ok AND {words("t", routing.CLAIM)}""",
    "sections": f"WITH {SECTIONS} SELECT heading_uid, n_blocks, n_chars FROM secs",
    "section_jobs": f"""WITH {SECTIONS}, {TEXTS}, k AS (SELECT secs.* FROM secs JOIN tr USING (journal_id, page_index) WHERE ok)
SELECT heading_uid, 'section_heading_scope_alignment' AS task_type FROM k WHERE n_chars >= 12 UNION ALL SELECT heading_uid, 'section_keypoint_summary' FROM k WHERE n_chars >= 220""",
    "page_windows": f"""WITH {TEXTS}, ch AS (SELECT *, CASE WHEN article_id IS NOT DISTINCT FROM lag(article_id) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new, row_number() OVER w AS pos FROM tr WINDOW w AS (PARTITION BY journal_id ORDER BY page_index)),
rn2 AS (SELECT *, sum(new) OVER (PARTITION BY journal_id ORDER BY page_index) AS run FROM ch),
w AS (SELECT a.journal_id, a.page_index, count(*) AS n, sum(length(x.t)) + count(*) - 1 AS chars, string_agg(x.page_index::VARCHAR, '|' ORDER BY x.page_index) AS "window" FROM rn2 a JOIN rn2 x ON x.journal_id = a.journal_id AND x.pos BETWEEN a.pos AND a.pos + 2 AND x.run = a.run AND x.ok GROUP BY ALL)
SELECT journal_id, page_index, "window" FROM w WHERE n >= 2 AND chars >= 120""",
    "article_jobs": f"""WITH {TEXTS}, n AS (SELECT *, row_number() OVER (PARTITION BY journal_id, article_id ORDER BY page_index) AS k FROM tr WHERE ok AND article_id <> 'article_unknown'),
g AS (SELECT journal_id, article_id, count(*) AS n_pages, (sum(length(t) + 1) - 1)::BIGINT AS n_chars, bool_or({words("t", routing.CONCLUSION)}) AS ends FROM n WHERE k <= 8 GROUP BY ALL) SELECT journal_id, article_id, n_pages, n_chars FROM g WHERE n_chars >= 800 OR ends""",
    "page_sentences": f"WITH {SENT} SELECT page_uid, len(s16)::INT AS n, coalesce(rtrim(left(s16[1], 220)), '') AS first, array_to_string({_with(generation.CLAIMS)}, '|') AS claims FROM sn",
    "claim_chains": f"WITH {SENT} SELECT journal_id, page_index, {_with(generation.CLAIMS, 1)}[1] AS claim FROM sn WHERE ok AND {words('t', routing.CLAIM)}",
    "contributions": f"""WITH {TEXTS}, n AS (SELECT *, row_number() OVER (PARTITION BY journal_id, article_id ORDER BY page_index) AS k FROM tr WHERE ok AND article_id <> 'article_unknown'),
g AS (SELECT journal_id, article_id, string_agg(t, ' ' ORDER BY page_index) AS t FROM n WHERE k <= 8 GROUP BY ALL), f AS (SELECT *, list_slice({_sentences('t')}, 1, 16) AS s16 FROM g WHERE length(t) >= 800 OR {words('t', routing.CONCLUSION)})
SELECT journal_id, article_id, rtrim(left(s16[1], 220)) AS problem, array_to_string({_with(generation.CONTRIBUTIONS)}, '|') AS contributions, array_to_string({_with(generation.FINDINGS)}, '|') AS findings, array_to_string({_with(generation.CONCLUSIONS)}, '|') AS conclusions FROM f""",
    "sample_ids": f"SELECT ordinal, format('{{}}_{{}}_p{{:03d}}_{{}}_{{}}_{{:06d}}', {_safe('metadata.journal_id', 'journal')}, {_safe('metadata.article_id', 'article_unknown')}, coalesce(metadata.page_index, 0), {_safe('metadata.block_id', 'page')}, coalesce(metadata.task_type, 'task'), coalesce(metadata.sample_no, 0)) AS made_id FROM samples",
    "quality_format": QUALITY,
    "quality_visual": QLT4,
    "image_pages": r"""WITH i AS (SELECT ordinal, coalesce(len(images), 0)::INT AS n_images, evidence.source_pages AS src, list_filter(list_transform(images, lambda x: regexp_extract(replace(x, chr(92), '/'), 'p(\d{1,4})', 1)), lambda x: x <> '') AS f FROM samples)
SELECT ordinal, n_images, coalesce(len(f), 0) < 1 OR coalesce(len(src), 0) < 1 OR list_has_all(src, list_transform(f, lambda x: x::INT)) AS in_sources FROM i""",
    "cross_page_bounds": f"SELECT ordinal, coalesce(task_type, '') <> '{quality.CROSS_TASK}' OR coalesce(len(images), 0) BETWEEN 2 AND 3 AS ok FROM samples",
    "figure_instructions": f"""WITH s AS (SELECT ordinal, {QUESTION} AS q, metadata.journal_id AS j, metadata.article_id AS a FROM samples WHERE task_type = '{quality.FIGURE_TASK}')
SELECT ordinal, q <> '' AND NOT {hit("q", quality.FIGURE_FORBIDDEN)} AND NOT EXISTS (SELECT 1 FROM articles t WHERE t.journal_id = s.j AND t.article_id = s.a AND t.article_title <> '' AND contains(s.q, {clean("t.article_title")})) AS generic FROM s""",
    "term_overlap": f"WITH s AS (SELECT ordinal, {_terms('q')} AS q, {_terms('a')} AS a FROM (SELECT ordinal, {QUESTION} AS q, {ANSWER} AS a FROM samples)) SELECT ordinal, len(list_intersect(q, a))::INT AS shared, len(a)::INT AS n_terms FROM s",
    "dedup_rules": """WITH s AS (SELECT ordinal, id, metadata.journal_id AS j, metadata.article_id AS a, metadata.page_index AS p, metadata.task_type AS t,
CASE WHEN coalesce(output_payload.text, '') <> '' THEN output_payload.text ELSE coalesce(question, '') || chr(31) || coalesce(answer, '') || chr(31) || coalesce(output_payload.summary, '') END AS h FROM samples)
SELECT ordinal, row_number() OVER (PARTITION BY j, id ORDER BY ordinal) = 1 AS first_id, row_number() OVER (PARTITION BY j, h ORDER BY ordinal) = 1 AS first_content, row_number() OVER (PARTITION BY j, a, p, t ORDER BY ordinal) <= 8 AS in_quota FROM s""",
    "dedup_near": rf"""WITH s AS (SELECT ordinal, metadata.journal_id AS j, regexp_replace(lower({CORPUS}), '[^\p{{L}}\p{{N}}_]', '', 'g') AS t FROM samples WHERE task_type = '{samples.CORPUS}'),
g AS (SELECT ordinal, j, CASE WHEN length(t) <= 3 THEN [t] ELSE list_distinct(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) END AS g FROM s WHERE t <> '')
SELECT x.ordinal AS a, y.ordinal AS b FROM g x JOIN g y ON x.j = y.j AND x.ordinal < y.ordinal WHERE len(list_intersect(x.g, y.g))::DOUBLE / least(len(x.g), len(y.g)) >= 0.92""",
    "export_pt": rf"SELECT * FROM (SELECT ordinal, regexp_replace({CORPUS}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') AS text FROM samples WHERE task_type = '{samples.CORPUS}') WHERE text <> ''",
    "export_counts": f"""WITH s AS (SELECT {FORMAT} AS format, coalesce(task_type, 'none') AS task, id FROM samples), r AS (SELECT CASE WHEN grouping(format) = 1 THEN 'all' ELSE format END AS format, CASE WHEN grouping(task) = 1 THEN 'all' ELSE task END AS task, count(*) AS n, count(DISTINCT id) AS n_ids FROM s GROUP BY ROLLUP (format, task)) SELECT * FROM r""",
    "evidence_blocks": """WITH e AS (SELECT ordinal, metadata.journal_id AS journal_id, unnest(evidence.evidence_block_ids) AS block_id, generate_subscripts(evidence.evidence_block_ids, 1) AS pos FROM samples), b AS (SELECT journal_id, block_id, min(block_type) AS block_type FROM journal_blocks GROUP BY ALL)
SELECT ordinal, n, block_id, block_type FROM (SELECT ordinal, block_id, block_type, row_number() OVER (PARTITION BY ordinal ORDER BY pos)::INT AS n FROM e JOIN b USING (journal_id, block_id)) WHERE n <= 8""",
    "parse_status": f"""WITH {BLOCKS}, g AS (SELECT journal_id, count(*) AS n_items, count(DISTINCT page_index) AS n_pages, sum(length(coalesce(text, ''))) AS n_chars FROM b GROUP BY ALL), j AS (SELECT journal_id, max(page_count) AS page_count FROM journals GROUP BY ALL)
SELECT journal_id, page_count, coalesce(n_items, 0) AS n_items, coalesce(n_pages, 0) AS n_pages, coalesce(n_chars, 0)::BIGINT AS n_chars, coalesce(n_items, 0) >= 1 AND coalesce(n_pages, 0) >= ceil(page_count * 0.75::DOUBLE) AND coalesce(n_chars, 0) >= 20 AS complete FROM j LEFT JOIN g USING (journal_id)""",
    "pending_pages": f"WITH {PAGES} SELECT journal_id, page_index FROM p WHERE NOT EXISTS (SELECT 1 FROM samples s WHERE s.metadata.journal_id = p.journal_id AND s.metadata.page_index = p.page_index)",
    "window_counts": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, count(DISTINCT user_id) AS users, sum(value) AS value FROM events GROUP BY ALL",
    "user_sessions": """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""",
    "page_roles_count": f"WITH {BLOCKS}, n AS (SELECT journal_id, page_index, column_label, count(*) AS n FROM b GROUP BY ALL) SELECT *, (sum(n) OVER (PARTITION BY journal_id, page_index))::BIGINT AS of FROM n",
}
