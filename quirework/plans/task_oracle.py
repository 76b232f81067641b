"""The queries of tasks in SQL, written for themselves, to compare results with."""

from __future__ import annotations

from quirework.functions import text as T
from quirework.operators import generation, links, outputs, pages, quality, routing, samples
from quirework.plans.oracle import ANSWER, ASSIGNED, BLOCKS, CORPUS, FORMAT, KIND, PAGE_TEXT, PAGES, PARAS, QLT4, QUALITY, QUESTION, RO, TEXTS, _minus, _safe, _sentences, _terms, clean, hit, names, q, words
from quirework.plans.task_queries import BUDGET
from quirework.sources import readers

STRIP = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
SHOWN = clean("CASE WHEN coalesce(markdown, '') <> '' THEN markdown ELSE text END")


def cut(c: str, n: int) -> str:
    return f"rtrim(left({clean(c)}, {n}))"


def first(c: str, n: int) -> str:
    return f"coalesce(rtrim(left(({_sentences(c)})[1], {n})), '')"


def picked(c: str, ws: tuple[str, ...], limit: int = 4) -> str:
    all16 = f"list_slice({_sentences(c)}, 1, 16)"
    hits = f"list_filter({all16}, lambda x: {words('x', ws)})"
    return f"list_transform(list_slice(CASE WHEN len({hits}) > 0 THEN {hits} ELSE {all16} END, 1, {limit}), lambda x: rtrim(left(x, 260)))"


def key_terms(c: str, limit: int = 8) -> str:
    listed = rf"regexp_extract({c}, '(?i)(关键词|Key\s*words?)\s*[:：]\s*(.+)', 2)"
    raw = rf"CASE WHEN {listed} <> '' THEN string_split_regex({listed}, '[;；,，、\s]+') ELSE regexp_extract_all({c}, '[A-Za-z][A-Za-z0-9\-_/]{{1,24}}|[一-鿿A-Za-z0-9]{{2,16}}') END"
    bare = rf"list_transform({raw}, lambda x: regexp_replace(x, '^[ ：:;；,，。、()（）\[\]【】]+|[ ：:;；,，。、()（）\[\]【】]+$', '', 'g'))"
    kept = f"list_filter({bare}, lambda x: length(x) >= 2 AND NOT list_contains([{names(generation.KEY_STOPWORDS)}], x))"
    return f"list_slice(list_filter({kept}, lambda x, i: list_position({kept}, x) = i), 1, {limit})"


OBJECTS = f"""ob AS (SELECT * FROM (SELECT *, {SHOWN} AS s, row_number() OVER (PARTITION BY journal_id, page_index ORDER BY block_ordinal, block_uid)::INT AS n FROM b WHERE block_type IN ({names(outputs.OBJECTS)}) OR semantic_role IN ({names(outputs.OBJECTS)})) WHERE n <= 12),
od AS (SELECT journal_id, page_index, block_uid, n, CASE WHEN s <> '' THEN rtrim(left(s, 420)) ELSE '页面中可见 ' || coalesce(block_type, '') || ' 区域' END AS description FROM ob)"""
GROUPED = f"""gp AS (SELECT journal_id, page_index, list_slice(list(block_id ORDER BY block_ordinal, block_uid) FILTER ({clean("text")} <> ''), 1, 32) AS ids, list_slice(list(text ORDER BY block_ordinal, block_uid) FILTER ({clean("text")} <> ''), 1, 16) AS texts,
  list(block_id ORDER BY block_ordinal, block_uid) FILTER (semantic_role IN ({names(outputs.NOISE_ROLES)})) AS noise, list_slice(list({clean("text")} ORDER BY block_ordinal, block_uid) FILTER (semantic_role = 'section_heading' AND {clean("text")} <> ''), 1, 4) AS headings,
  list(block_id || '=' || {cut("text", 180)} ORDER BY block_ordinal, block_uid) AS blocks FROM b GROUP BY ALL)"""
SUBJECT = f"CASE WHEN coalesce(p.article_title, '') <> '' THEN p.article_title ELSE {first(clean('p.full_text'), 120)} END"
LOWS = f"({names(routing.LOW_VALUE)})"
CONTROLLED = f"""
hs AS (SELECT *, {clean("text")} AS t, {SHOWN} AS s, sum(coalesce((semantic_role = 'section_heading')::INT, 0)) OVER (PARTITION BY journal_id, page_index ORDER BY {RO}, block_ordinal) AS sec FROM b),
hb AS (SELECT *, coalesce(semantic_role, '') NOT IN ('section_heading', {names(routing.UNCONTROLLED)}) AND t <> '' AS body FROM hs WHERE sec > 0),
hg AS (SELECT journal_id, page_index, sec, max(block_uid) FILTER (semantic_role = 'section_heading') AS heading_uid, max(t) FILTER (semantic_role = 'section_heading') AS heading, list(block_id ORDER BY {RO}, block_uid) FILTER (body) AS ids, string_agg(s, chr(10) ORDER BY {RO}, block_uid) FILTER (body AND s <> '') AS lines FROM hb GROUP BY ALL),
hc AS (SELECT hg.*, p.column_mode, rtrim(left({clean("lines")}, 5000)) AS c FROM hg JOIN p USING (journal_id, page_index) WHERE heading <> '')"""
VLINKS = f"""
lt AS (SELECT *, {clean("text")} AS t, trim(regexp_extract({clean("text")}, {q(T.LABEL)}, 1)) AS lab FROM b),
lx AS (SELECT v.block_uid, c.block_uid AS cu, c.block_id AS cid, c.lab, c.block_ordinal, least(abs(c.y0 - v.y1), abs(v.y0 - c.y1)) AS gap FROM lt v JOIN lt c USING (journal_id, page_index) WHERE v.block_type IN ('figure', 'table', 'formula') AND v.x0 IS NOT NULL AND c.x0 IS NOT NULL AND c.semantic_role IN ('figure_caption', 'table_caption')
  AND c.block_uid <> v.block_uid AND c.t <> '' AND greatest(0.0, least(v.x1, c.x1) - greatest(v.x0, c.x0)) / greatest(1.0, least(v.x1 - v.x0, c.x1 - c.x0)) >= 0.2),
lk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY block_uid ORDER BY gap, block_ordinal, cu) AS rank FROM lx) WHERE rank <= 2),
lg AS (SELECT block_uid, list(cid ORDER BY rank) AS captions, list(cu) AS cus, arg_min(lab, rank) FILTER (lab <> '') AS lab FROM lk GROUP BY ALL),
ll AS (SELECT lt.journal_id, lt.page_index, lt.block_uid, lt.block_id, lt.block_type, lt.block_ordinal, lt.t, lt.lab AS own, coalesce(lg.lab, lt.lab) AS label, coalesce(captions, []) AS captions, coalesce(cus, []) AS cus FROM lt LEFT JOIN lg USING (block_uid) WHERE lt.block_type IN ('figure', 'table', 'formula')),
lr AS (SELECT ll.block_uid, lt.block_id, row_number() OVER (PARTITION BY ll.block_uid ORDER BY lt.block_ordinal, lt.block_uid) AS n FROM ll JOIN lt USING (journal_id, page_index) WHERE ll.label <> '' AND ll.block_uid <> lt.block_uid AND contains(lower(regexp_replace(lt.t, '\\s+', '', 'g')), lower(regexp_replace(ll.label, '\\s+', '', 'g'))) AND NOT list_contains(ll.cus, lt.block_uid)),
lq AS (SELECT block_uid, list(block_id ORDER BY n) AS related FROM lr WHERE n <= 8 GROUP BY ALL),
vl AS (SELECT ll.*, coalesce(related, []) AS related FROM ll LEFT JOIN lq USING (block_uid))"""
BOUND = f"""
bd AS (SELECT vl.*, list_slice(list_filter(list_concat(captions, related), lambda x, i: x <> block_id AND list_position(list_concat(captions, related), x) = i), 1, 7) AS bound FROM vl),
be AS (SELECT block_uid, journal_id, page_index, unnest(bound) AS block_id, unnest(range(len(bound))) AS n FROM bd),
bi AS (SELECT journal_id, page_index, block_id, arg_max(t, block_uid) AS t, arg_max(coalesce(semantic_role IN ('figure_caption', 'table_caption'), false), block_uid) AS cap FROM lt GROUP BY ALL),
bg AS (SELECT be.block_uid, string_agg(bi.t, chr(10) ORDER BY n) FILTER (bi.t <> '' AND cap) AS caption, string_agg(bi.t, chr(10) ORDER BY n) FILTER (bi.t <> '' AND NOT cap) AS context FROM be JOIN bi USING (journal_id, page_index, block_id) GROUP BY ALL),
bv AS (SELECT bd.*, {cut("caption", 3600)} AS caption, {cut("context", 3600)} AS context FROM bd LEFT JOIN bg USING (block_uid))"""
ARTICLE = "ar AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY journal_id, article_id ORDER BY ingested_at DESC, article_uid DESC) AS k FROM articles) WHERE k = 1)"
JOBS = f"""jb AS (SELECT journal_id, page_index, unnest(list_filter([CASE WHEN coalesce(page_type, '') NOT IN ('blank', 'advertisement_or_notice') THEN 'page_to_journal_layout_description' END, CASE WHEN page_type = 'article_first_page' THEN 'article_metadata_extraction' END,
  CASE WHEN {hit("column_mode", "(two|three|four|five|six)_column")} OR len(uncertainty_notes) > 0 THEN 'two_column_reading_order_reconstruction' END, CASE WHEN ok AND {words("t", routing.METHOD)} THEN 'method_experiment_condition_extraction' END, CASE WHEN ok AND {words("t", routing.CLAIM)} THEN 'evidence_to_claim_chain' END], lambda x: x IS NOT NULL)) AS task_type FROM tr)"""
KEY = "concat_ws('|', coalesce(nullif(task_type, ''), metadata.task_type, ''), coalesce(metadata.journal_id, ''), coalesce(metadata.article_id, ''), coalesce(metadata.page_index, 0)::VARCHAR, coalesce(nullif(metadata.block_id, ''), 'page'))"
ILL, QA = names(samples.FORMATS["sharegpt"]), names((*samples.FORMATS["sharegpt"], *samples.FORMATS["alpaca"]))
LACKS = f"(CASE task_type {' '.join(f'WHEN {q(t)} THEN ' + (' OR '.join(f'''coalesce(output_payload.{f}, '') = '' ''' if f in ('text', 'summary') else 'true' for f in fs)) for t, fs in samples.REQUIRED.items())} ELSE false END)"
NOTHING = f"({clean('output_payload.text')} = '' AND {clean('output_payload.summary')} = '')"
ONLY = f"({hit('a', quality.UNUSABLE)} OR {hit('a', quality.AVAILABLE)}) AND len(list_slice(w, 1, 20)) < 4"
SCORE = "round_even(greatest(0.0::DOUBLE, least(1.0::DOUBLE, raw)), 3) AS score"
RELEVANCE = f"""
WITH s AS (SELECT *, {FORMAT} AS f, {QUESTION} AS q, {ANSWER} AS a FROM samples), t AS (SELECT *, {_terms("a")} AS w FROM s WHERE f IN ('sharegpt', 'alpaca')),
r AS (SELECT ordinal, 1.0::DOUBLE{_minus("q = '' OR a = ''", 0.55)}{_minus(LACKS, 0.45)}{_minus(NOTHING, 0.35)}{_minus(ONLY, 0.45)}{_minus("len(w) < 2", 0.25)}{_minus("task_type = 'article_metadata_extraction'", 0.3)} AS raw FROM t)
SELECT ordinal, {SCORE}, raw >= 0.70::DOUBLE AS passed FROM r"""
HEADS = r"(?:^|\s)(\d+(?:\.\d+)*\s+[一-鿿A-Za-z][^\s。；:：]{1,40})"
COVERAGE = f"""
WITH {PAGES}, s AS (SELECT ordinal, {clean(CORPUS)} AS o, {clean("p.full_text")} AS src FROM samples LEFT JOIN p ON p.journal_id = metadata.journal_id AND p.page_index = metadata.page_index WHERE task_type = '{samples.CORPUS}'),
r AS (SELECT ordinal, CASE WHEN src = '' THEN CASE WHEN o <> '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END ELSE round_even(greatest(0.0::DOUBLE, 1.0::DOUBLE{_minus("length(o)::DOUBLE / greatest(1, length(src)) < 0.65::DOUBLE", 0.45)}{_minus(f"len(list_filter(regexp_extract_all(src, {q(HEADS)}, 1), lambda h: NOT contains(o, h))) > 0", 0.45)}), 3) END AS score FROM s)
SELECT ordinal, score, score >= 0.70::DOUBLE AS passed FROM r"""
AGREE = r"""(len(list_transform(list_filter(list_transform(images, lambda x: regexp_extract(replace(x, chr(92), '/'), 'p(\d{1,4})', 1)), lambda x: x <> ''), lambda x: x::INT)) = 0 OR coalesce(len(evidence.source_pages), 0) = 0 OR images IS NULL
  OR len(list_filter(list_transform(list_filter(list_transform(images, lambda x: regexp_extract(replace(x, chr(92), '/'), 'p(\d{1,4})', 1)), lambda x: x <> ''), lambda x: x::INT), lambda x: NOT list_contains(evidence.source_pages, x))) = 0)"""
FILES = "fl AS (SELECT journal_id || '/' || page_image AS path FROM journal_pages WHERE page_image <> '' UNION SELECT journal_id || '/' || image_path FROM journal_blocks WHERE image_path <> ''), ms AS (SELECT ordinal, image FROM (SELECT ordinal, unnest(list_transform(images, lambda x: metadata.journal_id || '/' || x)) AS image FROM samples) WHERE image NOT IN (SELECT path FROM fl))"
BOUNDED = "(coalesce(metadata.block_id, '') <> '' AND coalesce(list_contains(evidence.evidence_block_ids, metadata.block_id), false))"
IMAGE = f"""
WITH {FILES}, bt AS (SELECT journal_id, block_id, min(text) AS text FROM journal_blocks GROUP BY ALL),
ev AS (SELECT ordinal, metadata.journal_id AS journal_id, unnest(evidence.evidence_block_ids) AS block_id, unnest(range(len(evidence.evidence_block_ids))) AS n FROM samples WHERE task_type IN ({ILL})),
su AS (SELECT ordinal, string_agg(text, ' ' ORDER BY n) AS support FROM ev JOIN bt USING (journal_id, block_id) WHERE {clean("text")} <> '' GROUP BY ALL),
s AS (SELECT samples.*, {ANSWER} AS a, {clean("support")} AS sup FROM samples LEFT JOIN su USING (ordinal) WHERE task_type IN ({ILL})),
t AS (SELECT *, len(list_intersect({_terms("a")}, {_terms("sup")})) >= 1 AS shared FROM s),
r AS (SELECT ordinal, 1.0::DOUBLE{_minus("coalesce(len(images), 0) < 1", 0.55)}{_minus("coalesce(len(images), 0) >= 1 AND ordinal IN (SELECT ordinal FROM ms)", 0.55)}{_minus("true", 0.2)}{_minus("NOT " + AGREE, 0.3)}{_minus(f"NOT (shared OR (task_type = '{samples.FIGURE_TASK}' AND {BOUNDED} AND sup <> ''))", 0.35)} AS raw FROM t)
SELECT ordinal, {SCORE}, raw >= 0.60::DOUBLE AS passed FROM r"""
OVERALL = f"""SELECT ordinal, round_even(list_reduce(list(score ORDER BY name), lambda a, x: a + x) / count(*), 3) AS score, bool_and(passed) AS passed, count(*)::INT AS n FROM (
SELECT ordinal, 'format' AS name, score, passed FROM ({QUALITY}) UNION ALL SELECT ordinal, 'coverage', score, passed FROM ({COVERAGE}) UNION ALL SELECT ordinal, 'relevance', score, passed FROM ({RELEVANCE}) UNION ALL SELECT ordinal, 'visual', score, passed FROM ({QLT4}) UNION ALL SELECT ordinal, 'image', score, passed FROM ({IMAGE})) GROUP BY ALL"""
SAID = f"regexp_replace(regexp_replace({clean('text')}, {q(quality.CAPTION_HEAD)}, ''), '^[ \\-—:：.．、]+|[ \\-—:：.．、]+$', '', 'g')"
GENERIC = f"""
WITH {BLOCKS}, {VLINKS},
cp AS (SELECT lt.journal_id, v.block_id, lt.text FROM lk JOIN lt ON lt.block_uid = lk.cu JOIN lt v ON v.block_uid = lk.block_uid UNION ALL SELECT journal_id, block_id, text FROM lt WHERE block_type IN ('figure', 'table', 'formula')),
sa AS (SELECT DISTINCT journal_id, block_id, {SAID} AS said FROM cp WHERE length({SAID}) >= 4),
s AS (SELECT ordinal, {QUESTION} AS q, metadata.journal_id AS j, metadata.article_id AS a, metadata.block_id AS bl FROM samples WHERE task_type = '{quality.FIGURE_TASK}')
SELECT ordinal, q <> '' AND NOT {hit("q", quality.FIGURE_FORBIDDEN)} AND NOT EXISTS (SELECT 1 FROM articles x WHERE x.journal_id = s.j AND x.article_id = s.a AND x.article_title <> '' AND contains(s.q, {clean("x.article_title")})) AND NOT EXISTS (SELECT 1 FROM sa WHERE sa.journal_id = s.j AND sa.block_id = s.bl AND contains(s.q, sa.said)) AS generic FROM s"""


def _gate(full: bool) -> str:
    more = f"""WHEN ordinal IN (SELECT ordinal FROM ms) THEN 'files'""" if full else ""
    last = "WHEN task_type = 'figure_table_formula_to_text' AND NOT coalesce(generic, false) THEN 'generic'" if full else ""
    end = "WHEN NOT coalesce(passed, false) THEN 'quality'" if full else ""
    joins = "LEFT JOIN ge USING (ordinal) LEFT JOIN qo USING (ordinal)" if full else ""
    ctes = f", {FILES}, ge AS ({GENERIC}), qo AS (SELECT ordinal, passed FROM ({OVERALL}))" if full else ""
    n = "coalesce(len(list_distinct(evidence.source_pages)), 0)"
    return f"""WITH {PAGES}{ctes}, pk AS (SELECT journal_id, page_index, page_type FROM p)
SELECT ordinal, id, task_type, CASE WHEN {FORMAT} = 'unknown' THEN 'task' WHEN coalesce(id, '') = '' THEN 'id' WHEN {FORMAT} = 'pt' AND length({clean(CORPUS)}) < 80 THEN 'short' WHEN {FORMAT} <> 'pt' AND {clean("instruction")} = '' THEN 'instruction'
WHEN {FORMAT} <> 'pt' AND {NOTHING} THEN 'payload' WHEN coalesce(pk.page_type, '') IN {LOWS} AND task_type <> 'page_to_journal_layout_description' THEN 'low_value' WHEN {LACKS} THEN 'fields' WHEN {n} < 1 THEN 'pages' WHEN task_type = 'cross_page_article_context' AND {n} < 2 THEN 'cross_page'
WHEN task_type IN ({ILL}) AND coalesce(len(images), 0) < 1 THEN 'images' {more} WHEN task_type = 'figure_table_formula_to_text' AND NOT {BOUNDED} THEN 'binding' {last} WHEN task_type = 'cross_page_article_context' AND coalesce(len(images), 0) NOT BETWEEN 2 AND 3 THEN 'bounds' {end} END AS reason
FROM samples LEFT JOIN pk ON pk.journal_id = metadata.journal_id AND pk.page_index = metadata.page_index {joins}"""


def _scalar(c: str, limit: int) -> str:
    t = rf"regexp_replace(regexp_replace(regexp_replace({clean(c)}, '(?i)\bbbox\s*=\s*\[[^\]]*\]', '', 'g'), '(?i)\bblock_id\s*[:=]\s*[\w.-]+', '', 'g'), '^[ ,;，；]+|[ ,;，；]+$', '', 'g')"
    return f"CASE WHEN length({t}) > {limit} THEN rtrim(left({t}, {limit})) || '...' ELSE {t} END" if limit else t


USABLE = rf"""CASE WHEN {hit("a5", r"^[{\[]")} AND (json_valid(a0) OR {hit("a5", r"^[{\[]\s*['\"]?(instruction|answer|output_payload|input_payload|metadata)")}) OR {hit("a5", samples.INTERNAL)} OR {hit("a5", f"(?i)\\b({'|'.join(sorted(samples.RAW_NAMES))})\\b\\s*[:：]")} THEN '' ELSE a5 END"""
EXPORTED = f"""
ea AS (SELECT *, {_scalar("answer", 5000)} AS a5, {_scalar("answer", 0)} AS a0, {_scalar("output_payload.summary", 1000)} AS sm, {_scalar("output_payload.text", 700)} AS tx FROM samples WHERE task_type IN ({QA})),
eu AS (SELECT *, {USABLE} AS u FROM ea),
ex AS (SELECT *, CASE WHEN u <> '' THEN u WHEN task_type IN ({ILL}) THEN {q(samples.NO_ANSWER)} WHEN sm <> '' THEN '摘要：' || sm WHEN tx <> '' THEN tx ELSE CASE WHEN output_payload.text IS NULL AND output_payload.summary IS NULL THEN '{{}}' ELSE to_json(output_payload)::VARCHAR END END AS exported FROM eu)"""
METADATA = f"""WITH {PAGES}, {ARTICLE}, jm AS (SELECT journal_id, max(journal_name) AS journal_name, max(pub_year) AS pub_year, max(volume) AS volume, max(issue) AS issue, max(source_pdf) AS source_pdf, max(pipeline_version) AS pipeline_version FROM journals GROUP BY ALL)"""
YEAR = r"(20\p{Nd}{2})"
ISSUES = (r"(20\p{Nd}{2})\s*年\s*第?\s*(\p{Nd}+)\s*卷\s*第?\s*(\p{Nd}+)\s*期", r"(20\p{Nd}{2})\P{Nd}{0,3}(\p{Nd}+)\P{Nd}{0,3}(\p{Nd}+)")


def _issue(c: str, k: int) -> str:
    other = f"regexp_extract({c}, {q(YEAR)}, 1)" if k == 1 else "''"
    return f"CASE WHEN {hit(c, ISSUES[0])} THEN regexp_extract({c}, {q(ISSUES[0])}, {k}) WHEN {hit(c, ISSUES[1])} THEN regexp_extract({c}, {q(ISSUES[1])}, {k}) ELSE {other} END"


# Corpus text as clean_corpus_text has it: line by line.
_LINE = rf"regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(x, '^[\s\p{{{{Z}}}}]+|[\s\p{{{{Z}}}}]+$', '', 'g'), {q(T.REFERENCE_MARK).replace('{', '{{').replace('}', '}}')}, '', 'g'), '[\s\p{{{{Z}}}}]+', ' ', 'g')), '\s+([，。；：！？、,.!?;:])', '\1', 'g')"
_BLANK = r"trim(regexp_replace(x, '[\s\p{{Z}}]+', ' ', 'g')) = ''"
CORPUS_CLEAN = rf"regexp_replace(regexp_replace(array_to_string(list_transform(list_filter(string_split(regexp_replace(coalesce({{}}, ''), '\r\n?', chr(10), 'g'), chr(10)), lambda x: {_BLANK} OR ({_LINE} <> '' AND upper({_LINE}) <> 'OSID:')), lambda x: CASE WHEN {_BLANK} THEN '' ELSE {_LINE} END), chr(10)), '\n{{{{3,}}}}', chr(10) || chr(10), 'g'), '^\n+|\n+$', '', 'g')"
SUBFIGURES = f"""f AS (SELECT *, {clean("text")} AS t, lower(regexp_extract({clean("text")}, {q(T.SUBFIGURE)}, 1)) AS mark FROM b WHERE block_type = 'figure' AND x0 IS NOT NULL),
m AS (SELECT *, trim(regexp_extract(regexp_replace(t, {q("^.*?" + T.SUBFIGURE)}, ''), {q(T.FIGURE_LABEL)}, 1)) AS label, row_number() OVER (PARTITION BY journal_id, page_index, column_label ORDER BY top, "left", reading_order, block_ordinal)::INT AS pos FROM f WHERE mark <> ''),
c AS (SELECT *, coalesce(sum((label <> '')::INT) OVER (PARTITION BY journal_id, page_index, column_label ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp FROM m),
g AS (SELECT journal_id, page_index, column_label, grp, max(label) AS label, list_slice(list({{'id': block_id, 'mark': mark}} ORDER BY pos), -{links.MAX_PENDING}, NULL) AS a FROM c GROUP BY ALL HAVING max(label) <> ''),
w AS (SELECT *, ceil(len(a) / 2.0)::INT AS parts, unnest(range(1, ceil(len(a) / 2.0)::INT + 1))::INT AS part FROM g WHERE len(a) >= 2),
z AS (SELECT *, list_slice(a, (part - 1) * 2 + 1, part * 2) AS mm FROM w)"""
CORPUS_WINDOWS = f"""WITH RECURSIVE {PAGES}, cp AS (SELECT journal_id, article_id, page_index, length({clean("full_text")}) AS n, row_number() OVER (PARTITION BY journal_id, article_id ORDER BY page_index) AS r FROM p WHERE page_type IN ('article_first_page', 'article_body') AND {clean("full_text")} <> ''),
cf AS (SELECT journal_id, article_id, page_index, n, r, 1 AS win, 1 AS pages, n AS chars FROM cp WHERE r = 1 UNION ALL
  SELECT cp.journal_id, cp.article_id, cp.page_index, cp.n, cp.r, CASE WHEN cf.chars >= {routing.CORPUS_CHARS} OR cf.pages >= {routing.CORPUS_PAGES} THEN win + 1 ELSE win END, CASE WHEN cf.chars >= {routing.CORPUS_CHARS} OR cf.pages >= {routing.CORPUS_PAGES} THEN 1 ELSE cf.pages + 1 END, CASE WHEN cf.chars >= {routing.CORPUS_CHARS} OR cf.pages >= {routing.CORPUS_PAGES} THEN cp.n ELSE cf.chars + cp.n END
  FROM cf JOIN cp ON cp.journal_id = cf.journal_id AND cp.article_id IS NOT DISTINCT FROM cf.article_id AND cp.r = cf.r + 1),
cw AS (SELECT journal_id, article_id, win, min(page_index) AS first_page, max(page_index) AS last_page, count(*) AS n_pages, sum(n)::BIGINT AS n_chars FROM cf GROUP BY ALL HAVING sum(n) >= {routing.MIN_CORPUS})"""
STRIP_WORDS = r"regexp_replace(lower(CASE WHEN coalesce(output_payload.text, '') <> '' THEN output_payload.text ELSE coalesce(text, '') END), '[^\p{L}\p{N}_]', '', 'g')"


def _noise(c: str, role: str, page: str) -> str:
    return rf"""({c} = '' OR upper({c}) = 'OSID:' OR starts_with({c}, '作者简介') OR ({hit(c, r"(?i)^Abstract\s*:")} AND {page} > 1) OR ({hit(c, r"(?i)^(Key\s*words?|Keywords?)\s*:")} AND {page} > 1) OR (coalesce({role}, '') IN ('abstract', 'keywords') AND {page} > 1 AND {hit(c, "^[A-Za-z]")})
 OR ({hit(c, r"[,，]\s*(19|20)\p{Nd}{2}\.?$")} AND length({c}) <= 90 AND {hit(c, generation.PUBLISHERS)}))"""


ORACLES: dict[str, str] = {
    "visual_objects": f"WITH {BLOCKS}, {OBJECTS} SELECT block_uid, n, description FROM od",
    "page_descriptions": f"""WITH {BLOCKS}, {PAGES}, {OBJECTS}, {GROUPED}, oo AS (SELECT journal_id, page_index, list(description ORDER BY n) AS objects FROM od GROUP BY ALL),
j AS (SELECT p.journal_id, p.page_index, p.page_type, p.column_mode, {SUBJECT} AS subject, coalesce(headings, []) AS headings, coalesce(objects, []) AS objects FROM p LEFT JOIN gp USING (journal_id, page_index) LEFT JOIN oo USING (journal_id, page_index))
SELECT journal_id, page_index, subject, len(objects)::INT AS n_objects, {clean(f'''concat_ws(' ', '该页为' || coalesce(page_type, '') || '，栏式结构为' || coalesce(column_mode, '') || '。', '页面正文主题围绕' || {cut("subject", 160)} || '。', CASE WHEN len(headings) > 0 THEN '可见小节包括：' || array_to_string(headings, '；') || '。' END,
CASE WHEN array_to_string(list_slice(objects, 1, 5), '；') <> '' THEN '页面中可见的图表/公式信息包括：' || array_to_string(list_slice(objects, 1, 5), '；') || '。' END)''')} AS description FROM j""",
    "page_outputs": f"""WITH {BLOCKS}, {PAGES}, {OBJECTS}, {GROUPED}, oo AS (SELECT journal_id, page_index, string_agg(description, '|' ORDER BY n) AS objects FROM od GROUP BY ALL),
rc AS (SELECT journal_id, page_index, coalesce(nullif(column_label, ''), 'unknown') AS r, count(*) AS n FROM b GROUP BY ALL), rg AS (SELECT journal_id, page_index, string_agg(r || ':' || n, '|' ORDER BY r) AS regions FROM rc GROUP BY ALL)
SELECT p.journal_id, p.page_index, regions, array_to_string(list_slice(blocks, 1, 18), '|') AS content, CASE WHEN gp.journal_id IS NULL THEN NULL ELSE coalesce(array_to_string(noise, '|'), '') END AS noise, coalesce(objects, '') AS objects, CASE WHEN coalesce(p.page_type, '') IN {LOWS} THEN '' ELSE {cut("p.full_text", 900)} END AS trainable, {cut("p.full_text", 2600)} AS restored,
array_to_string(p.uncertainty_notes, '|') AS notes FROM p LEFT JOIN gp USING (journal_id, page_index) LEFT JOIN oo USING (journal_id, page_index) LEFT JOIN rg USING (journal_id, page_index)""",
    "page_lists": f"""WITH {BLOCKS}, {GROUPED}, li AS (SELECT journal_id, page_index, coalesce(string_agg(block_id, '|' ORDER BY block_ordinal, block_uid) FILTER (semantic_role IN ('article_title', 'section_heading')), '') AS titles, {', '.join(f"coalesce(string_agg(block_id, '|' ORDER BY block_ordinal, block_uid) FILTER (block_type = '{k}'), '') AS {k}s" for k in ("figure", "table", "formula"))} FROM b GROUP BY ALL)
SELECT li.*, coalesce(array_to_string(ids, '|'), '') AS evidence_ids, coalesce(len(texts), 0)::INT AS n_texts, coalesce(length(array_to_string(texts, '|')), 0)::INT AS n_chars FROM li JOIN gp USING (journal_id, page_index)""",
    "heading_outputs": f"""WITH {BLOCKS}, {PAGES}, {CONTROLLED} SELECT heading_uid, heading, coalesce(array_to_string(ids, '|'), '') AS ids, length(c)::INT AS n_controlled, {first("c", 260)} AS scope, CASE WHEN {hit("coalesce(column_mode, '')", "(two|three|four|five|six)_column")} THEN {q(outputs.RISKS[0])} ELSE {q(outputs.RISKS[1])} END AS risk,
{first("c", 320)} AS summary, array_to_string({key_terms("c")}, '|') AS terms, array_to_string({picked("c", outputs.METHOD_POINTS)}, '|') AS methods, array_to_string({picked("c", outputs.RESULT_POINTS)}, '|') AS results FROM hc""",
    "heading_answers": f"""WITH {BLOCKS}, {PAGES}, {CONTROLLED}, ha AS (SELECT *, {clean(f"array_to_string({key_terms('c')}, ' ')")} AS te, {clean(f"array_to_string({picked('c', outputs.METHOD_POINTS)}, ' ')")} AS me, {clean(f"array_to_string({picked('c', outputs.RESULT_POINTS)}, ' ')")} AS re FROM hc)
SELECT heading_uid, {STRIP.format("'小节标题：' || heading || chr(10) || chr(10) || '小节正文：' || c")} AS export_input, rtrim(left({clean(f"concat_ws('；', nullif(heading, ''), nullif({first('c', 320)}, ''), nullif(te, ''), nullif(me, ''), nullif(re, ''))")}, 2600)) AS answer FROM ha""",
    "visual_outputs": f"""WITH {BLOCKS}, {TEXTS}, {VLINKS}, {BOUND}, bj AS (SELECT bv.*, CASE WHEN caption <> '' THEN caption WHEN bv.t <> '' THEN bv.t ELSE {q(outputs.NO_CAPTION)} END AS info FROM bv JOIN tr USING (journal_id, page_index) WHERE tr.ok)
SELECT block_uid, block_type AS object_type, CASE WHEN {clean("label")} <> '' THEN {clean("label")} ELSE own END AS object_label, CASE WHEN t <> '' THEN t ELSE info END AS visual_description, info AS caption_information, CASE WHEN context <> '' THEN context ELSE {q(outputs.NO_CONTEXT)} END AS text_explanation,
{first(f"(CASE WHEN context <> '' THEN context ELSE {clean('info')} END)", 320)} AS evidence_to_claim FROM bj""",
    "condition_outputs": f"""WITH {TEXTS}, c AS (SELECT *, {cut("full_text", 5000)} AS s FROM tr WHERE ok AND {words("t", routing.METHOD)})
SELECT journal_id, page_index, CASE WHEN coalesce(article_title, '') <> '' THEN article_title ELSE {first("s", 120)} END AS research_object, array_to_string({picked("s", outputs.ASSUMPTIONS, 3)}, '|') AS assumptions FROM c""",
    "claim_outputs": f"""WITH {BLOCKS}, {TEXTS}, {GROUPED}, {VLINKS}, c AS (SELECT *, {cut("full_text", 5000)} AS s FROM tr WHERE ok AND {words("t", routing.CLAIM)}),
sp AS (SELECT journal_id, page_index, string_agg(CASE WHEN label <> '' THEN label ELSE block_id END, '|' ORDER BY block_ordinal, block_uid) AS support FROM vl GROUP BY ALL)
SELECT c.journal_id, c.page_index, coalesce({picked("s", generation.CLAIMS, 1)}[1], '') AS claim, coalesce(array_to_string(list_slice(texts, 1, 4), '|'), '') AS evidence, coalesce(support, '') AS support FROM c LEFT JOIN gp USING (journal_id, page_index) LEFT JOIN sp USING (journal_id, page_index)""",
    "window_outputs": f"""WITH {TEXTS}, ch AS (SELECT *, CASE WHEN article_id IS NOT DISTINCT FROM lag(article_id) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new, row_number() OVER w AS pos FROM tr WINDOW w AS (PARTITION BY journal_id ORDER BY page_index)),
rn2 AS (SELECT *, sum(new) OVER (PARTITION BY journal_id ORDER BY page_index) AS run FROM ch),
w AS (SELECT a.journal_id, a.page_index AS first_page, x.page_index, coalesce(x.article_title, '') AS title, {first(cut("x.full_text", 5000), 220)} AS point, length(x.t) AS n FROM rn2 a JOIN rn2 x ON x.journal_id = a.journal_id AND x.pos BETWEEN a.pos AND a.pos + 2 AND x.run = a.run AND x.ok),
g AS (SELECT journal_id, first_page, arg_min(title, page_index) AS title, arg_min(point, page_index) AS one, coalesce(string_agg(point, ' ' ORDER BY page_index) FILTER (point <> ''), '') AS summary, string_agg(page_index::VARCHAR, '|' ORDER BY page_index) AS pages, count(*) AS k, sum(n) + count(*) - 1 AS chars FROM w GROUP BY ALL)
SELECT journal_id, first_page, CASE WHEN title <> '' THEN title ELSE one END AS topic, summary, pages FROM g WHERE k >= 2 AND chars >= 120""",
    "metadata_outputs": f"""{METADATA}, m AS (SELECT p.journal_id, p.page_index, p.page_label, p.article_title AS pt, {clean("p.full_text")} AS t, ar.article_uid IS NOT NULL AS found, ar.article_title AS att, ar.authors AS aa, ar.journal_name AS an, ar.pub_year AS ay, ar.volume AS av, ar.issue AS ai, ar.page_range AS ap, ar.doi AS ad, ar.abstract AS ab, ar.keywords AS ak,
jm.journal_name AS jn, jm.pub_year AS jy, jm.volume AS jv, jm.issue AS ji FROM p LEFT JOIN ar USING (journal_id, article_id) LEFT JOIN jm USING (journal_id) WHERE p.page_type = 'article_first_page')
SELECT journal_id, page_index, {clean(f"coalesce(nullif(att, ''), nullif(pt, ''), {first('t', 80)})")} AS title, array_to_string(coalesce(aa, []), '|') AS authors, coalesce(nullif(an, ''), jn, '') AS journal_name, coalesce(nullif(ay, ''), jy, '') AS year, coalesce(nullif(av, ''), jv, '') AS volume, coalesce(nullif(ai, ''), ji, '') AS issue, CASE WHEN found THEN coalesce(ap, '') ELSE coalesce(page_label, '') END AS pages,
coalesce(ad, '') AS doi, coalesce(ab, '') AS abstract, array_to_string(CASE WHEN found THEN coalesce(ak, []) ELSE {key_terms("t")} END, '|') AS keywords FROM m""",
    "job_metadata": f"""WITH {TEXTS}, {JOBS}, {METADATA.split("WITH ")[1].split(PAGES + ", ")[1]}
SELECT jm.source_pdf, jm.journal_name, jb.journal_id, p.article_id, CASE WHEN ar.article_uid IS NOT NULL THEN ar.article_title ELSE p.article_title END AS article_title, CASE WHEN ar.article_uid IS NOT NULL THEN ar.pub_year ELSE jm.pub_year END AS year, CASE WHEN ar.article_uid IS NOT NULL THEN ar.volume ELSE jm.volume END AS volume, CASE WHEN ar.article_uid IS NOT NULL THEN ar.issue ELSE jm.issue END AS issue,
jb.page_index, p.page_label, p.page_type, p.column_mode, 'page' AS block_id, 'page' AS block_type, 'page' AS semantic_role, coalesce(p.page_image, '') AS image_path, jb.task_type, jm.pipeline_version FROM jb JOIN p USING (journal_id, page_index) LEFT JOIN ar USING (journal_id, article_id) LEFT JOIN jm USING (journal_id)""",
    "article_authors": rf"""WITH {BLOCKS}, {PAGES}, a AS (SELECT b.*, {clean("b.text")} AS t, coalesce(y1, top) AS bottom, coalesce(p.height, 0) AS height FROM b JOIN p USING (journal_id, page_index) WHERE p.page_type = 'article_first_page'), n AS (SELECT * FROM a WHERE t <> ''),
ti AS (SELECT journal_id, page_index, coalesce(arg_min(bottom, (block_ordinal, block_uid)) FILTER (semantic_role = 'article_title'), arg_min(bottom, (top, "left", block_ordinal)) FILTER (semantic_role IN ('section_heading', 'body') AND top < greatest(1, height) * 0.35::DOUBLE)) AS edge FROM n GROUP BY ALL),
li AS (SELECT journal_id, page_index, arg_min(t, (block_ordinal, block_uid)) AS line FROM n JOIN ti USING (journal_id, page_index) WHERE top >= edge AND top <= edge + greatest(60.0::DOUBLE, height * 0.08::DOUBLE) AND coalesce(semantic_role, '') NOT IN ('abstract', 'keywords', 'journal_header', 'footer', 'page_number') GROUP BY ALL)
SELECT journal_id, page_index, array_to_string(list_slice(list_filter(string_split_regex(regexp_replace(line, '[\p{{Nd}},，\s]*(\(|（).*$', ''), '[,，、\s]+'), lambda x: length(x) BETWEEN 2 AND 8), 1, 12), '|') AS authors FROM li""",
    "page_note_texts": f"""WITH {ASSIGNED}, mo AS (SELECT journal_id, page_index, count(DISTINCT CASE WHEN ci >= 0 THEN ci END) = 2 AS two, bool_or(block_type IN ('figure', 'table', 'formula') AND col_label2 = 'full_width') AS wide FROM asg GROUP BY ALL)
SELECT journal_id, page_index, CASE WHEN two AND coalesce(wide, false) THEN {q("|".join(pages.NOTES))} WHEN two THEN {q(pages.NOTES[0])} ELSE '' END AS notes FROM mo""",
    "stored_order": f'WITH {BLOCKS} SELECT block_uid, row_number() OVER (PARTITION BY journal_id, page_index ORDER BY {RO}, top, "left", block_ordinal)::INT AS place FROM b',
    "visual_images": f"WITH {BLOCKS}, {PAGES} SELECT block_uid, coalesce(nullif(trim(coalesce(image_path, '')), ''), page_image, '') AS image FROM b LEFT JOIN p USING (journal_id, page_index) WHERE block_type IN ('figure', 'table', 'formula')",
    "links_or_default": f"""WITH {BLOCKS}, {VLINKS} SELECT journal_id, page_index, block_id, CASE WHEN label <> '' THEN array_to_string(list_concat([block_id], list_filter(list_concat(captions, related), lambda x, i: x <> block_id AND list_position(list_concat(captions, related), x) = i)), '|') ELSE block_id END AS evidence, CASE WHEN label <> '' THEN 'same_label_or_caption' ELSE 'target_block_only' END AS policy FROM vl""",
    "crop_rectangles": f"""WITH {BLOCKS}, {PAGES}, r AS (SELECT block_uid, {', '.join(f"greatest(0, least(round_even({c}, 0)::INT, {m})) AS {n}" for c, m, n in (("x0", "width", '"left"'), ("y0", "height", "top"), ("x1", "width", '"right"'), ("y1", "height", "bottom")))} FROM (SELECT b.block_uid, x0, y0, x1, y1, p.width, p.height FROM b JOIN p USING (journal_id, page_index)) WHERE x0 IS NOT NULL)
SELECT * FROM r WHERE "right" > "left" AND bottom > top""",
    "missing_images": f"WITH {FILES} SELECT ordinal, image FROM ms",
    "figures_bound": f"SELECT ordinal, {BOUNDED} AS bound FROM samples WHERE task_type = '{samples.FIGURE_TASK}'",
    "corpus_coverage": COVERAGE,
    "quality_relevance": RELEVANCE,
    "image_correspondence": IMAGE,
    "quality_overall": OVERALL,
    "figure_generic": GENERIC,
    "sample_gate": f"SELECT ordinal, id, reason FROM ({_gate(True)})",
    "failure_summary": f"""WITH g AS ({_gate(False)}), f AS (SELECT coalesce(task_type, 'none') AS task, reason, count(*) AS n, min(ordinal) AS o FROM g GROUP BY ALL)
SELECT task, sum(n)::BIGINT AS n, coalesce(sum(n) FILTER (reason IS NOT NULL), 0)::BIGINT AS n_failed, coalesce(array_to_string(list_slice(list(reason ORDER BY o) FILTER (reason IS NOT NULL), 1, 5), '|'), '') AS reasons FROM f GROUP BY ALL""",
    "display_texts": f"SELECT ordinal, {_scalar('answer', 60)} AS shown FROM samples",
    "export_answers": f"WITH {EXPORTED} SELECT ordinal, exported AS answer FROM ex",
    "export_sharegpt": f"WITH {EXPORTED} SELECT ordinal, id, trim(repeat('<image>', coalesce(len(images), 0)) || trim(replace(coalesce(instruction, ''), '<image>', ''))) AS asked, exported AS answered FROM ex WHERE task_type IN ({ILL})",
    "export_alpaca": f"""WITH {BLOCKS}, {PAGES}, {CONTROLLED}, {EXPORTED}, hx AS (SELECT hc.*, b.block_id FROM hc JOIN b ON b.block_uid = hc.heading_uid),
xi AS (SELECT ex.*, CASE WHEN ex.task_type IN ('article_metadata_extraction', 'method_experiment_condition_extraction') THEN {cut("p.full_text", 5000)}
WHEN ex.task_type = 'section_heading_scope_alignment' THEN {STRIP.format("'小节标题：' || coalesce(hx.heading, '') || chr(10) || chr(10) || '正文范围：' || coalesce(hx.c, '')")} WHEN ex.task_type = 'section_keypoint_summary' THEN {STRIP.format("'小节标题：' || coalesce(hx.heading, '') || chr(10) || chr(10) || '小节正文：' || coalesce(hx.c, '')")}
ELSE {STRIP.format("'文章题名：' || coalesce(p.article_title, '') || chr(10) || chr(10) || '正文片段：' || " + cut("p.full_text", 10000))} END AS given
FROM ex LEFT JOIN p ON p.journal_id = ex.metadata.journal_id AND p.page_index = ex.metadata.page_index LEFT JOIN hx ON hx.journal_id = ex.metadata.journal_id AND hx.page_index = ex.metadata.page_index AND hx.block_id = ex.metadata.block_id WHERE ex.task_type IN ({names(samples.FORMATS["alpaca"])}))
SELECT ordinal, coalesce(instruction, '') AS instruction, CASE WHEN {clean("given")} <> '' THEN given ELSE '{{}}' END AS input, exported AS output, metadata.journal_id AS journal_id, metadata.sample_no AS sample_no, array_to_string(nullif(images, []), '|') AS images FROM xi""",
    "pt_records": f"""WITH {PAGES} SELECT ordinal, {STRIP.format(CORPUS)} AS text, 0 AS part FROM samples WHERE task_type = '{samples.CORPUS}' AND {STRIP.format(CORPUS)} <> ''
UNION ALL SELECT ordinal, concat_ws(chr(10), CASE WHEN coalesce(p.article_title, '') <> '' THEN '文章：' || p.article_title END, CASE WHEN coalesce(nullif(p.page_label, ''), metadata.page_index::VARCHAR, '') <> '' THEN '页码：' || coalesce(nullif(p.page_label, ''), metadata.page_index::VARCHAR, '') END) AS text, 1 AS part
FROM samples LEFT JOIN p ON p.journal_id = metadata.journal_id AND p.page_index = metadata.page_index WHERE task_type = '{samples.FIGURE_TASK}' AND output_payload IS NOT NULL""",
    "payload_hashes": """SELECT ordinal, sha256('{"summary":' || coalesce(to_json(output_payload.summary)::VARCHAR, 'null') || ',"text":' || coalesce(to_json(output_payload.text)::VARCHAR, 'null') || '}') AS hash FROM samples""",
    "maybe_json": "SELECT event_id, CASE WHEN json_valid(props) THEN json(props)::VARCHAR ELSE props END AS value FROM events",
    "folded_payloads": f"""WITH {PAGES}, t AS (SELECT page_uid, coalesce(full_text, '') AS f, coalesce(visible_text, '') AS v FROM p)
SELECT page_uid, CASE WHEN length(f) >= 200 THEN '<同 template_input.source_text，内容不再重复>' ELSE f END AS "full", CASE WHEN length(v) >= 200 AND v = f THEN '<同 template_input.source_text，内容不再重复>' ELSE v END AS visible,
CASE WHEN length(f) >= 200 THEN '<同 template_input.source_text，内容不再重复>' ELSE f END AS first FROM t""",
    "fitted_payloads": f"""WITH {PAGES}, t AS (SELECT page_uid, to_json(coalesce(full_text, ''))::VARCHAR AS f, to_json(coalesce(visible_text, ''))::VARCHAR AS v, to_json(coalesce(article_title, ''))::VARCHAR AS a, to_json(coalesce(page_label, ''))::VARCHAR AS l FROM p),
s AS (SELECT page_uid, length(f) AS nf, length(v) AS nv, length(a) AS na, length('{{' || chr(10) || '  "context": {{' || chr(10) || '    "template_input": {{' || chr(10) || '      "label": ' || l || chr(10) || '    }},' || chr(10) || '    "full": ' || f || ',' || chr(10) || '    "visible": ' || v || ',' || chr(10) || '    "title": ' || a || chr(10) || '  }}' || chr(10) || '}}') AS total, length('<超出 prompt 预算 {BUDGET} 字符，本字段已省略>') + 2 AS note FROM t),
e AS (SELECT page_uid, total, note, unnest(['full', 'visible', 'title']) AS k, unnest([nf, nv, na]) AS n, unnest([1, 2, 3]) AS i FROM s),
w AS (SELECT *, total - coalesce(sum(n - note) OVER (PARTITION BY page_uid ORDER BY n DESC, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > {BUDGET} AS gone FROM e)
SELECT page_uid, bool_or(gone) FILTER (k = 'full') AS full_left_out, bool_or(gone) FILTER (k = 'visible') AS visible_left_out, bool_or(gone) FILTER (k = 'title') AS title_left_out FROM w GROUP BY ALL""",
    "journal_rows": f"""WITH i AS (SELECT DISTINCT source_pdf AS path, CASE WHEN length(journal_id) % 2 = 0 THEN journal_name END AS n FROM journals), k AS (SELECT journal_name AS name, min(journal_id) AS id FROM journals WHERE length(journal_name) % 2 = 0 GROUP BY ALL),
r AS (SELECT path, coalesce(nullif(trim(n), ''), regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\\.[^.]*$', '')) AS journal_name FROM i)
SELECT path, journal_name, coalesce(k.id, {_safe("journal_name", "untitled_journal")}) AS journal_id, {_issue("journal_name", 1)} AS year, {_issue("journal_name", 2)} AS volume, {_issue("journal_name", 3)} AS issue FROM r LEFT JOIN k ON k.name = r.journal_name""",
    "issue_fields": f"""WITH j AS (SELECT DISTINCT journal_id, journal_name AS n, coalesce(pub_year, '') AS y, coalesce(volume, '') AS v, coalesce(issue, '') AS i FROM journals), m AS (SELECT journal_id, unnest([n || y || '年第' || v || '卷 第' || i || '期', n || '-' || y || '-' || v || '-' || i, n || ' ' || y]) AS name FROM j)
SELECT DISTINCT journal_id, name, {_issue("name", 1)} AS year, {_issue("name", 2)} AS volume, {_issue("name", 3)} AS issue FROM m""",
    "sample_ranks": f"""WITH {PAGES}, k AS (SELECT ordinal, {KEY} AS key, EXISTS (SELECT 1 FROM p WHERE p.journal_id = metadata.journal_id AND p.page_index = metadata.page_index) AS there FROM samples)
SELECT ordinal, key, row_number() OVER (PARTITION BY key ORDER BY ordinal)::INT AS n FROM k WHERE key IN (SELECT key FROM k WHERE there)""",
    "task_completion": f"""WITH {TEXTS}, {JOBS}, a AS (SELECT journal_id, task_type, count(*) AS n_jobs FROM jb GROUP BY ALL), c AS (SELECT metadata.journal_id AS journal_id, task_type, count(*) AS n_samples FROM samples WHERE task_type IS NOT NULL GROUP BY ALL)
SELECT journal_id, task_type, coalesce(n_jobs, 0) AS n_jobs, coalesce(n_samples, 0) AS n_samples, coalesce(n_jobs, 0) = 0 OR coalesce(n_samples, 0) > 0 AS complete FROM a FULL JOIN c USING (journal_id, task_type)""",
    "pending_tasks": f"""WITH {TEXTS}, {JOBS}, a AS (SELECT journal_id, task_type, count(*) AS n_jobs FROM jb GROUP BY ALL), c AS (SELECT metadata.journal_id AS journal_id, task_type, count(*) AS n_samples FROM samples WHERE task_type IS NOT NULL GROUP BY ALL),
d AS (SELECT journal_id, list(task_type) FILTER (coalesce(n_jobs, 0) = 0 OR coalesce(n_samples, 0) > 0) AS done FROM a FULL JOIN c USING (journal_id, task_type) GROUP BY ALL),
o AS (SELECT journal_id, list_filter([{names(tuple(t for f in ("sharegpt", "alpaca", "pt") for t in samples.FORMATS[f]))}], lambda x: NOT coalesce(list_contains(done, x), false)) AS o FROM d) SELECT journal_id, array_to_string(o, '|') AS tasks FROM o WHERE len(o) > 0""",
    "open_jobs": f"""WITH {TEXTS}, {JOBS}, jk AS (SELECT concat_ws('|', task_type, jb.journal_id, p.article_id, jb.page_index::VARCHAR, 'page') AS key FROM jb JOIN p USING (journal_id, page_index)), r AS (SELECT ordinal, {KEY} AS key FROM samples), st AS (SELECT key, count(*) AS n, count(*) + max(ordinal) % 3 - 1 AS due FROM r GROUP BY ALL)
SELECT jk.key FROM jk LEFT JOIN st USING (key) WHERE NOT CASE WHEN due IS NULL THEN coalesce(n, 0) > 0 ELSE due = 0 OR n >= due END""",
    "repeated_forms": f"""WITH {BLOCKS}, n AS (SELECT journal_id, column_label AS form, count(DISTINCT page_index) AS n_pages FROM b WHERE column_label <> '' GROUP BY ALL), t AS (SELECT journal_id, count(DISTINCT page_index) AS total FROM b GROUP BY ALL)
SELECT journal_id, form, n_pages FROM n JOIN t USING (journal_id) WHERE n_pages >= greatest(1, round_even(total * 0.6::DOUBLE, 0)::INT)""",
    "page_titles": f"WITH {PAGES}, {ARTICLE} SELECT page_uid, coalesce(ar.article_title, '') AS title FROM p LEFT JOIN ar USING (journal_id, article_id)",
    "journal_times": "SELECT DISTINCT journal_id, strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created FROM journals",
    "caption_labels": f"""WITH {BLOCKS}, t AS (SELECT *, {clean("text")} AS t FROM b) SELECT block_uid, CASE lower(coalesce(block_type, '')) {' '.join(f"WHEN {q(k)} THEN {q(v)}" for k, v in readers.BLOCK_TYPES.items())} ELSE 'unknown' END AS block_type, {KIND} AS kind, trim(regexp_extract(t, {q(T.LABEL)}, 1)) AS label FROM t""",
    "article_metadata": rf"""WITH {BLOCKS}, {PAGES}, m AS (SELECT b.*, p.journal_name, {clean("b.text")} AS t FROM b JOIN p USING (journal_id, page_index) WHERE p.page_type = 'article_first_page'),
g AS (SELECT journal_id, page_index, any_value(journal_name) AS jn, arg_min(t, (block_ordinal, block_uid)) FILTER (semantic_role = 'article_title' AND t <> '') AS title, coalesce(arg_min(t, (block_ordinal, block_uid)) FILTER ({hit("t", "^(摘要|摘 要|Abstract)")}), '') AS abstract,
  coalesce(arg_min(t, (block_ordinal, block_uid)) FILTER ({hit("t", "^(关键词|Key words|Keywords)")}), '') AS kw, coalesce(arg_min(t, (block_ordinal, block_uid)) FILTER ({hit("t", T.DOI)}), '') AS dl FROM m GROUP BY ALL)
SELECT journal_id, page_index, coalesce(title, {clean("jn")}) AS title, abstract, array_to_string(list_filter(list_transform(string_split_regex(trim(regexp_replace(kw, '(?i)^(关键词|Key\s*words?)\s*[:：]?', '')), '[;；,，]\s*'), lambda x: regexp_replace(x, '^[ ;；,，]+|[ ;；,，]+$', '', 'g')), lambda x: x <> ''), '|') AS keywords,
regexp_extract(dl, {q(T.DOI)}, 0) AS doi, CASE WHEN title IS NOT NULL THEN 0.82::DOUBLE ELSE 0.45::DOUBLE END AS confidence FROM g""",
    "subfigure_groups": f"""WITH {BLOCKS}, {SUBFIGURES}
SELECT journal_id, page_index, column_label, mm[1].id AS target, label, 'figure:' || regexp_extract(translate(label, '０１２３４５６７８９', '0123456789'), '[0-9]+', 0) AS label_key, part, parts, array_to_string(list_transform(mm, lambda x: x.id), '|') AS members, array_to_string(list_transform(mm, lambda x: x.mark), '|') AS marks FROM z""",
    "corpus_windows": f"""{CORPUS_WINDOWS} SELECT journal_id, article_id, first_page, last_page, n_pages, n_chars FROM cw""",
    "corpus_lines": f"""WITH {PAGES}, c AS (SELECT page_uid, {CORPUS_CLEAN.format("full_text")} AS c FROM p) SELECT page_uid, length(c)::INT AS n_chars, sha256(c) AS hash FROM c""",
    "method_conditions": f"""WITH {TEXTS} SELECT journal_id, page_index, {', '.join(f"array_to_string({picked('t', ws)}, '|') AS {n}" for n, ws in (("method_steps", generation.METHOD_STEPS), ("conditions", generation.CONDITIONS), ("metrics", generation.METRICS)))}, array_to_string({key_terms("t", 12)}, '|') AS variables FROM tr WHERE ok AND {words("t", routing.METHOD)}""",
    "corpus_samples": f"""WITH RECURSIVE {PARAS}, {CORPUS_WINDOWS.split(PAGES + ", ", 1)[1]},
li AS (SELECT journal_id, article_id, start_page AS page_index, string_agg(l, chr(10) ORDER BY paragraph) AS lines FROM (SELECT *, {clean("text")} AS l FROM paras) WHERE role NOT IN ({names(generation.UNREAD_ROLES)}) AND NOT {_noise("l", "role", "start_page")} GROUP BY ALL),
re AS (SELECT journal_id, article_id, page_index, string_agg(shown, chr(10) ORDER BY {RO}, block_ordinal) AS lines FROM vb WHERE (journal_id, article_id, page_index) NOT IN (SELECT (journal_id, article_id, start_page) FROM paras) AND NOT {_noise("shown", "semantic_role", "page_index")} GROUP BY ALL),
al AS (SELECT * FROM li UNION ALL SELECT * FROM re),
pw AS (SELECT cw.journal_id, cw.article_id, cw.first_page, cw.last_page, p.page_index, p.journal_name, p.article_title, CASE WHEN {clean("p.page_label")} = '' THEN p.page_index::VARCHAR ELSE {clean("p.page_label")} END AS label, lines FROM cw JOIN p ON p.journal_id = cw.journal_id AND p.article_id = cw.article_id AND p.page_index BETWEEN cw.first_page AND cw.last_page LEFT JOIN al ON al.journal_id = p.journal_id AND al.article_id = p.article_id AND al.page_index = p.page_index),
jo AS (SELECT journal_id, article_id, first_page, last_page, string_agg('[页码：' || label || ']' || CASE WHEN lines IS NULL THEN '' ELSE chr(10) || lines END, chr(10) || chr(10) ORDER BY page_index) AS raw, arg_min(label, page_index) AS l1, arg_max(label, page_index) AS l2, arg_min(journal_name, page_index) AS jn, arg_min(article_title, page_index) AS title FROM pw GROUP BY ALL)
SELECT journal_id, article_id, first_page, last_page, '期刊：' || coalesce(jn, '') || chr(10) || '文章：' || CASE WHEN {clean("title")} <> '' THEN {clean("title")} ELSE article_id END || chr(10) || '页码：' || CASE WHEN l1 = l2 THEN l1 ELSE l1 || '-' || l2 END || chr(10) || chr(10) || {CORPUS_CLEAN.format("raw")} AS text FROM jo""",
    "parsed_responses": r"""SELECT 'event' AS source, event_id::VARCHAR AS id, CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT' THEN 1 ELSE -1 END::INT AS n FROM events UNION ALL SELECT 'sample', id, CASE WHEN json_valid(answer) AND json_type(answer) = 'OBJECT' THEN 1 WHEN regexp_matches(answer, '^[^\[]*\[\s*(\d+(\s*,\s*\d+)*)?\s*\]') THEN 0 ELSE -1 END::INT FROM samples""",
    "dedup_kept": f"""WITH RECURSIVE s AS (SELECT ordinal, coalesce(metadata.journal_id, '') AS j, coalesce(id, chr(1)) AS id, metadata.article_id AS a, metadata.page_index AS p, metadata.task_type AS t, task_type, CASE WHEN coalesce(output_payload.text, '') <> '' THEN output_payload.text ELSE coalesce(question, '') || chr(31) || coalesce(answer, '') || chr(31) || coalesce(output_payload.summary, '') END AS c, {STRIP_WORDS} AS w FROM samples),
g AS (SELECT ordinal, j, CASE WHEN length(w) < 3 THEN [w] ELSE list_distinct(list_transform(range(1, length(w) - 1), lambda i: substr(w, i, 3))) END AS g FROM s WHERE task_type = '{samples.CORPUS}' AND w <> ''),
gu AS (SELECT ordinal, j, len(g) AS n, unnest(g) AS gram FROM g), ov AS (SELECT x.ordinal AS a, y.ordinal AS b, least(any_value(x.n), any_value(y.n)) AS n, count(*) AS k FROM gu x JOIN gu y ON x.j = y.j AND x.gram = y.gram AND x.ordinal < y.ordinal GROUP BY ALL),
nr AS (SELECT a, b FROM ov WHERE k / n::DOUBLE >= 0.92::DOUBLE),
o AS (SELECT *, row_number() OVER (PARTITION BY j ORDER BY ordinal) AS r, (SELECT list(a) FROM nr WHERE nr.b = s.ordinal) AS near FROM s),
k(j, r, ordinals, ids, contents, slots, last) AS (SELECT j, 0::BIGINT, []::BIGINT[], []::VARCHAR[], []::VARCHAR[], []::VARCHAR[], NULL::BIGINT FROM s GROUP BY j
  UNION ALL SELECT z.j, z.r, CASE WHEN z.keep THEN list_append(z.ordinals, z.ordinal) ELSE z.ordinals END, CASE WHEN z.keep THEN list_append(z.ids, z.id) ELSE z.ids END, CASE WHEN z.keep THEN list_append(z.contents, z.h) ELSE z.contents END, CASE WHEN z.keep THEN list_append(z.slots, z.slot) ELSE z.slots END, CASE WHEN z.keep THEN z.ordinal END
  FROM (SELECT k.j, o.r, o.ordinal, o.id, md5(o.c) AS h, concat_ws('|', coalesce(a, '~'), coalesce(p::VARCHAR, '~'), coalesce(t, '~')) AS slot, k.ordinals, k.ids, k.contents, k.slots, NOT list_contains(k.ids, o.id) AND NOT list_contains(k.contents, md5(o.c)) AND len(list_filter(k.slots, lambda x: x = concat_ws('|', coalesce(a, '~'), coalesce(p::VARCHAR, '~'), coalesce(t, '~')))) < {samples.QUOTA} AND NOT coalesce(list_has_any(k.ordinals, near), false) AS keep FROM k JOIN o ON o.j = k.j AND o.r = k.r + 1) z)
SELECT last AS ordinal FROM k WHERE last IS NOT NULL""",
    "linked_page_jobs": f"""WITH {BLOCKS}, {TEXTS} SELECT journal_id, page_index, 'two_column_reading_order_reconstruction' AS task_type FROM tr WHERE NOT coalesce({hit("column_mode", "(two|three|four|five|six)_column")} OR len(uncertainty_notes) > 0, false) AND EXISTS (SELECT 1 FROM b WHERE b.journal_id = tr.journal_id AND b.page_index = tr.page_index AND b.block_type IN ('figure', 'table', 'formula'))""",
    "visual_jobs": f"""WITH {BLOCKS}, {TEXTS}, {SUBFIGURES}, sk AS (SELECT journal_id, page_index, unnest(list_transform(mm[2:], lambda x: x.id)) AS block_id FROM z)
SELECT b.journal_id, b.page_index, block_uid, block_id, block_type, 'figure_table_formula_to_text' AS task_type FROM b JOIN tr USING (journal_id, page_index) WHERE tr.ok AND block_type IN ('figure', 'table', 'formula') AND NOT EXISTS (SELECT 1 FROM sk WHERE sk.journal_id = b.journal_id AND sk.page_index = b.page_index AND sk.block_id = b.block_id)""",
    "unheaded_page_jobs": f"""WITH {BLOCKS}, {TEXTS}, u AS (SELECT journal_id, page_index, bool_or(coalesce(semantic_role = 'section_heading', false) AND {clean("text")} <> '') AS headed, (sum(length({clean("text")}) + 1) FILTER (block_type IN ({names(routing.TEXT_TYPES)}) AND length({clean("text")}) >= 12) - 1)::INT AS n_chars FROM b GROUP BY ALL)
SELECT journal_id, page_index, n_chars, 'section_keypoint_summary' AS task_type FROM u JOIN tr USING (journal_id, page_index) WHERE NOT headed AND n_chars >= 220 AND tr.ok AND length({clean("full_text")}) >= 120""",
    "page_inputs": f"""WITH {TEXTS}, {JOBS}, g AS (SELECT jb.task_type, p.*, {PAGE_TEXT} AS pt, {cut("p.full_text", 5000)} AS f5, task_type = 'page_to_journal_layout_description' AS lay, task_type = 'two_column_reading_order_reconstruction' AS ord FROM jb JOIN p USING (journal_id, page_index))
SELECT journal_id, page_index, task_type, CASE WHEN task_type <> 'method_experiment_condition_extraction' THEN coalesce(page_image, '') ELSE '-' END AS page_image, CASE WHEN lay THEN coalesce(page_type, '-') ELSE '-' END AS page_type, CASE WHEN lay OR ord THEN coalesce(column_mode, '-') ELSE '-' END AS column_mode, CASE WHEN lay OR ord THEN rtrim(left(pt, 5000)) ELSE '-' END AS ocr_text,
CASE WHEN lay OR ord THEN f5 ELSE '-' END AS paragraph_text, CASE WHEN ord THEN coalesce(array_to_string(reading_order_blocks, '|'), '-') ELSE '-' END AS reading_order, CASE WHEN task_type IN ('method_experiment_condition_extraction', 'evidence_to_claim_chain') THEN coalesce(article_title, '') ELSE '-' END AS article_title, CASE WHEN NOT lay AND NOT ord THEN f5 ELSE '-' END AS source_text FROM g""",
}
