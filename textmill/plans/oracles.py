"""The same queries as SQL, to check the DataFrame results against."""

from __future__ import annotations

from textmill import constants as K
from textmill.operators.viterbi import CANDIDATES, CLASSES, END, START, TAGS

# pieces used by several statements

METHOD = """CASE WHEN {0} % 8 <= 2 THEN 'POS' WHEN {0} % 8 <= 4 THEN 'CONSTITUENCY'
  WHEN {0} % 8 <= 6 THEN 'DEPENDENCY' ELSE 'NER' END"""
URL = "'https://corpus.example.org/f/' || {0} || '/' || {0} || '-0.txt'"
TRIM = r"regexp_replace({0}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
STEM = r"regexp_replace(regexp_replace(regexp_extract({0}, '[^/]*$'), '\.[^.]*$', ''), '[^a-zA-Z0-9_-]', '_', 'g')"
SENTENCES = (
    "[s FOR s IN [" + TRIM.format("r") + " FOR r IN regexp_extract_all({0}, '[^.!?]+[.!?]*')] IF s <> '']"
)
TOKENS = r"regexp_extract_all({0}, '[\p{{L}}\p{{N}}]+|[^\t\n\x0b\x0c\r \p{{L}}\p{{N}}]')"
WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"


def _tag(tok: str) -> str:
    def listed(words):
        return ", ".join("'" + w + "'" for w in words)

    parts = [f"WHEN {tok} IN ('.', '!', '?') THEN '.'", f"WHEN {tok} IN (',', ';', ':') THEN {tok}"]
    parts += [f"WHEN lower({tok}) IN ({listed(words)}) THEN '{name}'" for name, words in K.CLOSED_CLASS.items()]
    parts += [
        rf"WHEN NOT regexp_matches({tok}, '^[\p{{L}}\p{{N}}]') THEN 'SYM'",
        f"WHEN regexp_matches({tok}, '^[0-9]+$') THEN 'CD'",
        f"WHEN {tok}[1] <> lower({tok}[1]) THEN 'NNP'",
    ]
    parts += [f"WHEN suffix(lower({tok}), '{end}') THEN '{name}'" for end, name in K.SUFFIX_TAGS]
    return "CASE " + " ".join(parts) + " ELSE 'NN' END"


MANIFEST = f"""lines AS (
  SELECT source AS job_id, doc_id AS line_no,
    CASE WHEN doc_id % 50 = 0 THEN {METHOD.format('doc_id')} || ' ' || {URL.format('doc_id')}
         WHEN doc_id % 50 = 1 THEN chr(9) || {URL.format('doc_id')}
         WHEN doc_id % 50 = 2 THEN {METHOD.format('doc_id')} || chr(9) || {URL.format('doc_id')} || chr(9) || 'note'
         ELSE {METHOD.format('doc_id')} || chr(9) || {URL.format('doc_id')} END
    || CASE WHEN doc_id % 3 = 0 THEN chr(13) ELSE '' END AS line
  FROM documents
  UNION ALL
  SELECT source, doc_id + 1000000000, {METHOD.format('doc_id')} || chr(9) || 'missing/' || doc_id || '.txt'
  FROM documents WHERE doc_id % 20 = 0),
fields AS (
  SELECT job_id, line_no, string_split(regexp_replace(line, '\\t*\\r?$', ''), chr(9)) AS f FROM lines),
parts AS (
  SELECT job_id, line_no, len(f) AS n, {TRIM.format('f[1]')} AS method, {TRIM.format('f[2]')} AS url FROM fields),
tasks AS (
  SELECT job_id, line_no, method, url FROM parts WHERE n >= 2 AND method <> '' AND url <> '')"""

RESULTS = f"""{MANIFEST},
docs AS (SELECT {URL.format('doc_id')} AS url, text FROM documents),
fetched AS (
  SELECT t.job_id, t.line_no, t.method, t.url,
    CASE WHEN t.method IN ('POS', 'CONSTITUENCY', 'DEPENDENCY') THEN d.text END AS text,
    CASE WHEN t.method NOT IN ('POS', 'CONSTITUENCY', 'DEPENDENCY') THEN 'Invalid parsing method: ' || t.method
         WHEN d.url IS NULL THEN 'Document not found' END AS error
  FROM tasks t LEFT JOIN docs d ON t.url = d.url),
results AS (
  SELECT job_id, line_no, url AS original_url, method AS parsing_method,
    CASE WHEN error IS NULL THEN 's3://text-results/workers-results/' || job_id || '/' || method || '-'
      || {STEM.format('url')} || '-' || line_no || '.txt' END AS output_url,
    error IS NULL AS success, error AS error_message
  FROM fetched)"""

SENTENCE_ROWS = f"""sentence_lists AS (SELECT doc_id, {SENTENCES.format('text')} AS ss FROM documents),
sentences AS (
  SELECT doc_id, i - 1 AS sent_idx, ss[i] AS sent
  FROM (SELECT doc_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM sentence_lists))"""

TOKEN_ROWS = f"""{SENTENCE_ROWS},
token_lists AS (SELECT doc_id, sent_idx, {TOKENS.format('sent')} AS ts FROM sentences),
tokens AS (
  SELECT doc_id, sent_idx, i - 1 AS pos, ts[i] AS tok, len(ts) AS size
  FROM (SELECT doc_id, sent_idx, ts, unnest(range(1, len(ts) + 1)) AS i FROM token_lists)),
tagged AS (SELECT *, {_tag('tok')} AS tag FROM tokens)"""

FETCHED_TAGGED = f"""{RESULTS},
ok AS (SELECT * FROM fetched WHERE error IS NULL),
sentence_lists AS (SELECT line_no, {SENTENCES.format('text')} AS ss FROM ok),
token_lists AS (
  SELECT line_no, i - 1 AS sent_idx, {TOKENS.format('ss[i]')} AS ts
  FROM (SELECT line_no, ss, unnest(range(1, len(ss) + 1)) AS i FROM sentence_lists)),
tokens AS (
  SELECT line_no, sent_idx, i - 1 AS pos, ts[i] AS tok, len(ts) AS size
  FROM (SELECT line_no, sent_idx, ts, unnest(range(1, len(ts) + 1)) AS i FROM token_lists)),
tagged AS (SELECT *, {_tag('tok')} AS tag FROM tokens)"""

LEAF = "'(' || tag || ' ' || CASE tok WHEN '(' THEN '-LRB-' WHEN ')' THEN '-RRB-' ELSE tok END || ')'"


def _tree(keys: str, source: str = "tagged") -> str:
    return (
        f"SELECT {keys}, sent_idx, max(size) AS size, "
        f"'(ROOT (S ' || string_agg({LEAF}, ' ' ORDER BY pos) || '))' AS tree FROM {source} GROUP BY {keys}, sent_idx"
    )


def _relation() -> str:
    parts = [f"WHEN '{t}' THEN '{r}'" for t, r in K.SHALLOW_RELATIONS.items() if t != "PUNCT"]
    parts += [f"WHEN '{t}' THEN 'punct'" for t in (".", ",", ";", ":", "SYM")]
    return "CASE tag " + " ".join(parts) + " ELSE 'dep' END"


def _edges(keys: str) -> str:
    line = (
        "CASE WHEN pos = size - 1 THEN 'root(ROOT-0' ELSE "
        f"{_relation()} || '(' || lead(tok) OVER w || '-' || (pos + 2) END || ', ' || tok || '-' || (pos + 1) || ')'"
    )
    return f"SELECT {keys}, sent_idx, pos, {line} AS edge FROM tagged WINDOW w AS (PARTITION BY {keys}, sent_idx ORDER BY pos)"


def _spans(keys: str) -> str:
    """Nodes of ``trees`` (keys, sent_idx, tree): the k-th bracket that opens a level goes with the k-th that closes it."""
    each = f"{keys}, sent_idx"
    return f"""pieces AS (
  SELECT {each}, i, ps[i] AS p, CASE WHEN i > 1 THEN ps[i - 1] ELSE '' END = '(' AS label,
    CASE WHEN ps[i + 1] NOT IN ('(', ')') THEN ps[i + 1] END AS p1, CASE WHEN ps[i + 2] NOT IN ('(', ')') THEN ps[i + 2] END AS p2
  FROM (SELECT {each}, ps, unnest(range(1, len(ps) + 1)) AS i
    FROM (SELECT {each}, regexp_extract_all(tree, '\\(|\\)|[^()\\s]+') AS ps FROM trees))),
levels AS (
  SELECT *, sum(CASE p WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER w + CASE p WHEN ')' THEN 1 ELSE 0 END AS level,
    sum(CASE WHEN p NOT IN ('(', ')') AND NOT label THEN 1 ELSE 0 END) OVER w AS words
  FROM pieces WINDOW w AS (PARTITION BY {each} ORDER BY i ROWS UNBOUNDED PRECEDING)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {each}, level, p ORDER BY i) AS k,
    row_number() OVER (PARTITION BY {each}, p ORDER BY i) - 1 AS node FROM levels WHERE p IN ('(', ')')),
opens AS (SELECT * FROM ranked WHERE p = '('),
nodes AS (
  SELECT {', '.join('o.' + c.strip() for c in each.split(','))}, o.i, o.node, o.level, coalesce(o.p1, '') AS label,
    CASE WHEN o.p1 IS NOT NULL THEN o.p2 END AS word, o.words AS start, c.words AS "end"
  FROM opens o JOIN ranked c ON c.p = ')' AND c.level = o.level AND c.k = o.k AND {' AND '.join(f'c.{c.strip()} = o.{c.strip()}' for c in each.split(','))}),
spans AS (
  SELECT {', '.join('n.' + c.strip() for c in each.split(','))}, n.node, a.node AS parent, n.level - 1 AS depth, n.label, n.word, n.start, n."end"
  FROM nodes n ASOF LEFT JOIN nodes a ON {' AND '.join(f'a.{c.strip()} = n.{c.strip()}' for c in each.split(','))}
    AND a.level = n.level - 1 AND a.i < n.i)"""


SPAN_ROW = """node::INTEGER AS node, parent::INTEGER AS parent, depth::INTEGER AS depth, label, word,
  start::INTEGER AS start, "end"::INTEGER AS "end\""""


def _chunks() -> str:
    nouns = r"regexp_replace(tree, '(\((?:DT|PRP\$|JJ|JJS|CD|NN|NNS|NNP) [^() ]+\))', '(NP \1)', 'g')"
    merged = rf"regexp_replace({nouns}, '\)\) \(NP \(', ') (', 'g')"
    linked = rf"regexp_replace({merged}, '(\((?:IN|TO) [^() ]+\)) \(NP ', '(PP \1 (NP' || chr(9), 'g')"
    return rf"SELECT doc_id, sent_idx, regexp_replace({linked}, '\(NP\t(.*?)\)\)', '(NP \1)))', 'g') AS tree FROM flat"


def _viterbi() -> str:
    """Tags by context: pair scores from the tags by form, one decoding, scores again from it, and the decoding asked for.

    One row for each token of a sentence so far: the best score and path (the numbers of its candidates) to each candidate.
    """
    candidates = ", ".join(f"('{c}', {j}, '{t}', {len(ts)})" for c, ts in CANDIDATES.items() for j, t in enumerate(ts))
    tags = ", ".join(f"('{t}')" for t in TAGS)

    def pairs(rows: str) -> str:
        return f"""SELECT a, b, count(*) AS n FROM (
    SELECT CASE WHEN pos = 0 THEN '{START}' ELSE lag(tag) OVER w END AS a, tag AS b FROM {rows}
    WINDOW w AS (PARTITION BY doc_id, sent_idx ORDER BY pos)
    UNION ALL SELECT tag, '{END}' FROM {rows} WHERE pos = size - 1) GROUP BY a, b"""

    def steps(rows: str) -> str:
        return f"""SELECT x.tag AS a, y.tag AS b,
    floor(1000 * ln((coalesce(n, 0) + 1.0::DOUBLE) / (coalesce(whole, 0) + {len(TAGS)})))::BIGINT AS s
  FROM tags x CROSS JOIN tags y LEFT JOIN {rows} p ON p.a = x.tag AND p.b = y.tag
    LEFT JOIN (SELECT a, sum(n) AS whole FROM {rows} GROUP BY a) t ON t.a = x.tag"""

    width = range(max(map(len, CANDIDATES.values())))

    def best(j: int, name: str) -> str:
        """The path to candidate ``j``: of equally good ones over the earlier candidate."""
        cases = " ".join(f"WHEN s{i} + {name}[{4 * i + j + 1}] = n{j} THEN p{i}" for i in width)
        return f"CASE {cases} END || '{j}' AS p{j}"

    def paths(name: str, step: str, form: str) -> str:
        reach = ", ".join(f"greatest({', '.join(f's{i} + t[{4 * i + j + 1}]' for i in width)}) AS n{j}" for j in width)
        return f"""{name}_edge AS MATERIALIZED (
  SELECT x.kind AS k1, y.kind AS k2, list(p.s + f.s ORDER BY x.j, y.j) AS t
  FROM full_cand x CROSS JOIN full_cand y LEFT JOIN {step} p ON p.a = x.tag AND p.b = y.tag
    LEFT JOIN {form} f ON f.kind = y.kind AND f.tag = y.tag GROUP BY x.kind, y.kind),
{name}_first AS MATERIALIZED (
  SELECT c.kind, list(p.s + f.s ORDER BY c.j) AS t
  FROM full_cand c LEFT JOIN {step} p ON p.a = '{START}' AND p.b = c.tag LEFT JOIN {form} f ON f.kind = c.kind AND f.tag = c.tag
  GROUP BY c.kind),
{name}_last AS MATERIALIZED (
  SELECT c.kind, list(p.s ORDER BY c.j) AS t FROM full_cand c LEFT JOIN {step} p ON p.a = c.tag AND p.b = '{END}' GROUP BY c.kind),
{name}_v AS (
  SELECT doc_id, sent_idx, 1 AS step, ks, {', '.join(f't[{j + 1}] AS s{j}' for j in width)}, {', '.join(f"'{j}' AS p{j}" for j in width)}
  FROM lines JOIN {name}_first ON kind = ks[1]
  UNION ALL
  SELECT doc_id, sent_idx, step, ks, {', '.join(f'n{j}' for j in width)}, {', '.join(best(j, 't') for j in width)}
  FROM (
    SELECT doc_id, sent_idx, step + 1 AS step, ks, t, {', '.join(f's{i}, p{i}' for i in width)}, {reach}
    FROM {name}_v JOIN {name}_edge ON k1 = ks[step] AND k2 = ks[step + 1] WHERE step < len(ks))),
{name}_best AS MATERIALIZED (
  SELECT doc_id, sent_idx, CASE {' '.join(f'WHEN s{j} + t[{j + 1}] = n THEN p{j}' for j in width)} END AS path
  FROM (SELECT *, greatest({', '.join(f's{j} + t[{j + 1}]' for j in width)}) AS n
    FROM {name}_v JOIN {name}_last ON kind = ks[step] WHERE step = len(ks))),
{name} AS MATERIALIZED (
  SELECT k.doc_id, k.sent_idx, k.pos, k.size, k.tok, k.kind, c.tag
  FROM kinds k LEFT JOIN {name}_best b USING (doc_id, sent_idx)
    JOIN cand c ON c.kind = k.kind AND c.j = coalesce(path[k.pos + 1]::INTEGER, 0))"""

    return f"""WITH RECURSIVE {TOKEN_ROWS},
cand(kind, j, tag, n) AS (VALUES {candidates}),
tags(tag) AS (VALUES {tags}),
kinds AS MATERIALIZED (
  SELECT doc_id, sent_idx, pos, size, tok, CASE WHEN tag = 'NNP' THEN 'NNP/' || {_tag('lower(tok)')} ELSE tag END AS kind, tag
  FROM tagged),
lines AS MATERIALIZED (
  SELECT doc_id, sent_idx, list(kind ORDER BY pos) AS ks FROM kinds GROUP BY doc_id, sent_idx),
full_cand AS (
  SELECT kind, j, tag FROM (SELECT DISTINCT kind FROM cand) CROSS JOIN (SELECT unnest(range({len(width)})) AS j) LEFT JOIN cand USING (kind, j)),
pairs0 AS MATERIALIZED ({pairs('kinds')}),
step0 AS MATERIALIZED ({steps('pairs0')}),
form0 AS MATERIALIZED (
  SELECT kind, c.tag, floor(1000 * ln((c.n - j) / (coalesce(whole, 0) + (SELECT sum(n) FROM pairs0) // {len(TAGS)} + 1)::DOUBLE))::BIGINT AS s
  FROM cand c LEFT JOIN (SELECT a, sum(n) AS whole FROM pairs0 GROUP BY a) t ON t.a = c.tag),
{paths('first', 'step0', 'form0')},
pairs1 AS MATERIALIZED ({pairs('first')}),
step1 AS MATERIALIZED ({steps('pairs1')}),
seen AS MATERIALIZED (SELECT kind, tag, count(*) AS n FROM first GROUP BY kind, tag),
form1 AS MATERIALIZED (
  SELECT c.kind, c.tag, floor(1000 * ln((coalesce(s.n, 0) + 1.0::DOUBLE) / (coalesce(whole, 0) + {len(CLASSES)})))::BIGINT AS s
  FROM cand c LEFT JOIN seen s ON s.kind = c.kind AND s.tag = c.tag
    LEFT JOIN (SELECT tag, sum(n) AS whole FROM seen GROUP BY tag) t ON t.tag = c.tag),
{paths('second', 'step1', 'form1')}
SELECT doc_id, CAST(sent_idx AS INTEGER) AS sent_idx, CAST(pos AS INTEGER) AS pos, tok, tag FROM second"""


COMPLETIONS = """completions AS (
  SELECT event_id AS msg_id, user_id AS job_id, event_type <> 'error' AS success, ts FROM events),
redelivered AS (SELECT * FROM completions UNION ALL SELECT * FROM completions WHERE msg_id % 7 = 0),
jobs AS (
  SELECT user_id AS job_id, count(*) + user_id % 2 AS total,
    CASE WHEN user_id % 4 > 0 THEN user_id % 4 ELSE 1 END AS n
  FROM events WHERE user_id % 10 <> 9 GROUP BY user_id),
once AS (
  SELECT msg_id, min(job_id) AS job_id, min(success) AS success, min(ts) AS ts FROM redelivered GROUP BY msg_id)"""

PROGRESS = f"""{COMPLETIONS},
done AS (SELECT job_id, count(DISTINCT msg_id) AS done FROM redelivered GROUP BY job_id),
open_jobs AS (
  SELECT j.job_id, j.total, j.n, coalesce(d.done, 0) AS done,
    greatest(j.total - coalesce(d.done, 0), 0) AS remaining
  FROM jobs j LEFT JOIN done d ON j.job_id = d.job_id),
progress AS (
  SELECT *, CAST(ceil(remaining / n) AS BIGINT) AS need, done >= total AS complete FROM open_jobs)"""

# even events ask, odd ones answer the one before; what the watermark of both streams has reached at the end
CORRELATED = """requests AS (SELECT event_id AS task_id, user_id AS job_id, ts AS sent FROM events WHERE event_id % 2 = 0),
responses AS (
  SELECT event_id - 1 AS task_id, event_type <> 'signup' AS success, ts AS answered
  FROM events WHERE event_id % 2 = 1 AND event_type <> 'error'),
correlated AS (
  SELECT q.task_id, q.job_id, q.sent, r.answered, r.success FROM requests q LEFT JOIN responses r
    ON r.task_id = q.task_id AND r.answered >= q.sent AND r.answered <= q.sent + INTERVAL 4 MINUTE),
mark AS (
  SELECT date_trunc('millisecond', least((SELECT max(sent) FROM requests), (SELECT max(answered) FROM responses)))
    - INTERVAL 1 HOUR AS w)"""

# messages as the events read, and their decoded parts
MESSAGES = """raw AS (
  SELECT event_id, user_id, event_type, event_id % 10 = 0 AS empty,
    CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 4
      WHEN 0 THEN 'POS' WHEN 1 THEN 'CONSTITUENCY' WHEN 2 THEN 'DEPENDENCY' ELSE 'NER' END AS method
  FROM events),
routed AS (
  SELECT event_id AS msg_id,
    CASE event_type WHEN 'view' THEN 'task' WHEN 'click' THEN CASE WHEN empty THEN 'no_data' ELSE 'job' END
      WHEN 'purchase' THEN 'control' WHEN 'signup' THEN 'unknown_type' ELSE 'malformed' END AS route,
    CASE WHEN event_type = 'view' THEN CASE WHEN empty THEN 'unknown' ELSE CAST(user_id AS VARCHAR) END
         WHEN event_type = 'click' AND NOT empty THEN CAST(user_id AS VARCHAR) END AS job_id,
    CASE WHEN event_type = 'view' THEN CASE WHEN empty THEN 'unknown' ELSE method END END AS method,
    CASE WHEN event_type = 'view' THEN CASE WHEN empty THEN 'unknown'
      ELSE 'https://corpus.example.org/e/' || event_id END END AS url,
    CASE WHEN event_type = 'click' AND NOT empty THEN 'input/' || user_id || '/input.txt' END AS input_key,
    CASE WHEN event_type = 'click' AND NOT empty
      THEN CASE WHEN event_id % 4 > 0 THEN event_id % 4 ELSE 1 END END AS n
  FROM raw)"""

WORD_ROWS = f"""word_lists AS (SELECT doc_id, lang, {WORDS.format('text')} AS ws FROM documents),
words AS (
  SELECT doc_id, lang, i - 1 AS pos, ws[i] AS w
  FROM (SELECT doc_id, lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM word_lists))"""

STOP = f"""{WORD_ROWS},
df AS (SELECT lang, w, count(DISTINCT doc_id) AS df FROM words GROUP BY lang, w),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY df DESC, w) AS rank FROM df),
stop AS (SELECT lang, w, df, rank FROM ranked WHERE rank <= 20)"""

ALL_BIGRAMS = """pairs AS (
  SELECT lang, w AS w1, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS w2 FROM words),
all_bigrams AS (SELECT lang, w1, w2, count(*) AS n FROM pairs WHERE w2 IS NOT NULL GROUP BY lang, w1, w2)"""

BIGRAMS = f"""{STOP}, {ALL_BIGRAMS},
bigrams AS (
  SELECT * FROM all_bigrams b
  WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.lang = b.lang AND s.w = b.w1)
    AND NOT EXISTS (SELECT 1 FROM stop s WHERE s.lang = b.lang AND s.w = b.w2))"""


def _xlogx(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN {x} * ln({x}) ELSE 0 END"


TEMPLATES = f"""{WORD_ROWS},
neighbours AS (
  SELECT doc_id, pos AS place, w AS a, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS b FROM words),
templates AS (
  SELECT doc_id, CAST(place AS INTEGER) AS place, CASE WHEN place % 4 = 0 THEN a || ' to' ELSE a END AS p, b AS q,
    a AS p_verb, CASE WHEN place % 4 = 0 THEN 'to' ELSE '' END AS p_prep, b AS q_verb, '' AS q_prep,
    place % 3 = 0 AS swapped
  FROM neighbours WHERE b IS NOT NULL)"""


def _escape(text: str) -> str:
    for plain, entity in K.HTML_ESCAPES:
        text = "replace({}, '{}', '{}')".format(text, plain.replace("'", "''"), entity)
    return text


def _link(url: str) -> str:
    return (
        f"CASE WHEN regexp_matches({url}, '^s3://[^/]*/') THEN 'https://s3.console.aws.amazon.com/s3/object/' || "
        f"regexp_extract({url}, '^s3://([^/]*)/', 1) || '?prefix=' || regexp_replace({url}, '^s3://[^/]*/', '') "
        f"ELSE {url} END"
    )


HTML_LINE = f"""CASE WHEN success THEN '<p class="ok">' ELSE '<p class="failed">' END
  || '<b>' || {_escape('parsing_method')} || '</b>: <a href="' || {_escape('original_url')} || '">'
  || {_escape('original_url')} || '</a> '
  || CASE WHEN success THEN '<a href="' || {_escape(_link('output_url'))} || '">[Output]</a>'
     ELSE '<i>' || {_escape('error_message')} || '</i>' END || '</p>' || chr(10)"""

ORACLES: dict[str, str] = {
    "manifest_tasks": f"WITH {MANIFEST} SELECT * FROM tasks",
    "manifest_rejects": f"""WITH {MANIFEST}
SELECT job_id, line_no, CASE WHEN n < 2 THEN 'too few fields' ELSE 'empty field' END AS reason
FROM parts WHERE n < 2 OR method = '' OR url = ''""",
    "manifest_scan": f"WITH {MANIFEST} SELECT 'run 1: ' || job_id AS job_id, method, url FROM tasks",
    "task_messages": f"""WITH {MANIFEST}
SELECT job_id, line_no, '{{"type":"urlParseRequest","data":{{"parsingMethod":"' || method || '","url":"' || url
  || '","jobId":"' || job_id || '"}}}}' AS body FROM tasks""",
    "method_validation": f"""WITH {MANIFEST}
SELECT job_id, line_no, method, method IN ('POS', 'CONSTITUENCY', 'DEPENDENCY') AS valid,
  CASE WHEN method NOT IN ('POS', 'CONSTITUENCY', 'DEPENDENCY') THEN 'Invalid parsing method: ' || method END AS error
FROM tasks""",
    "route_messages": f"WITH {MESSAGES} SELECT * FROM routed",
    "job_requests": """WITH j AS (
  SELECT DISTINCT source AS job_id, CAST(substr(source, 4) AS INTEGER) % 4 AS n FROM documents)
SELECT job_id, '{"type":"newTask","data":{"inputFileS3Key":"input/' || job_id || '/input.txt","n":' || n
  || ',"jobId":"' || job_id || '"}}' AS body FROM j WHERE n > 0""",
    "task_result_messages": f"""WITH {RESULTS}
SELECT job_id, line_no, '{{"type":"urlParseResponse","data":{{"success":' || success || ',"jobId":"' || job_id || '"}}}}'
  AS body FROM results""",
    "decode_completions": """SELECT event_id AS msg_id, CAST(user_id AS VARCHAR) AS job_id, event_type <> 'error' AS success
FROM events WHERE event_id % 10 <> 0 AND event_type <> 'signup'""",
    "job_sizes": f"WITH {MANIFEST} SELECT job_id, count(*) AS total FROM tasks GROUP BY job_id",
    "document_scan": f"""WITH bodies AS (
  SELECT {URL.format('doc_id')} AS url, text FROM documents UNION ALL SELECT url, html FROM pages)
SELECT url, length(text) AS n_chars, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, md5(text) AS digest FROM bodies""",
    "fetch_or_error": f"""WITH {RESULTS}
SELECT job_id, line_no, method, url, length(text) AS n_chars, error FROM fetched""",
    "result_rows": f"WITH {RESULTS} SELECT * FROM results",
    "result_scan": f"WITH {RESULTS} SELECT * FROM results",
    "missing_results": f"WITH {RESULTS} SELECT * FROM tasks WHERE line_no % 11 = 0",
    "failure_reasons": """WITH e AS (
  SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id AS msg_id, CASE WHEN k % 5 = 0 THEN 'NER' ELSE 'POS' END AS method,
  CASE WHEN k % 5 = 0 THEN 'Invalid parsing method: NER' WHEN event_type = 'error' THEN 'Task Timed Out'
    WHEN event_type = 'signup' THEN 'Worker Interrupted'
    WHEN event_type = 'purchase' THEN 'HTTP ' || (k + 400) END AS error
FROM e""",
    "output_keys": f"""SELECT page_id, {STEM.format('url')} AS stem,
  'workers-results/job' || (page_id % 7) || '/' || {METHOD.format('page_id')} || '-' || {STEM.format('url')} || '.txt'
    AS output_key
FROM pages""",
    "object_links": f"""WITH keyed AS (
  SELECT doc_id, CASE doc_id % 4
    WHEN 0 THEN 's3://text-results/workers-results/' || source || '/' || {METHOD.format('doc_id')} || '-' || doc_id || '-0.txt'
    WHEN 1 THEN 's3://text-results' WHEN 2 THEN {URL.format('doc_id')} END AS url
  FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(url, '^s3://[^/]*/') THEN regexp_extract(url, '^s3://([^/]*)/', 1) END AS bucket,
  regexp_replace(url, '^s3://[^/]*/', '') AS object_key, {_link('url')} AS link
FROM keyed""",
    "html_escape": f"""SELECT 'd' || doc_id AS id, {_escape('text')} AS escaped FROM documents
UNION ALL SELECT 'p' || page_id, {_escape('html')} FROM pages""",
    "summary_stats": f"""WITH {RESULTS}
SELECT job_id, parsing_method AS method, count(*) AS total, count(*) FILTER (success) AS successes,
  count(*) FILTER (NOT success) AS errors, CAST(grouping(job_id, parsing_method) AS INTEGER) AS level
FROM results GROUP BY GROUPING SETS ((job_id, parsing_method), (job_id), (parsing_method), ())""",
    "summary_html": f"""WITH {RESULTS},
all_jobs AS (SELECT DISTINCT source AS job_id FROM documents),
totals AS (
  SELECT j.job_id, count(r.job_id) AS total, count(*) FILTER (r.success) AS good,
    coalesce(max(r.line_no) // 1000 + 2, 1) AS foot_no
  FROM all_jobs j LEFT JOIN results r ON j.job_id = r.job_id GROUP BY j.job_id)
SELECT job_id, line_no // 1000 + 1 AS part_no, string_agg({HTML_LINE}, '' ORDER BY line_no) AS html
FROM results GROUP BY job_id, line_no // 1000
UNION ALL
SELECT job_id, 0, '<!DOCTYPE html>' || chr(10) || '<html lang="en"><head><meta charset="UTF-8"><title>Results</title>'
  || '</head><body>' || chr(10) || '<p>Total: ' || total || ' | Success: ' || good || ' | Errors: ' || (total - good)
  || '</p>' || chr(10) FROM totals
UNION ALL
SELECT job_id, foot_no, '</body></html>' || chr(10) FROM totals""",
    "job_responses": f"""WITH {PROGRESS}
SELECT CAST(job_id AS VARCHAR) AS job_id, 'local-app-output-' || job_id AS reply_to,
  'output/' || job_id || '_summary.html' AS summary_key
FROM progress WHERE complete AND job_id % 4 = 0""",
    "sentences": f"WITH {SENTENCE_ROWS} SELECT doc_id, CAST(sent_idx AS INTEGER) AS sent_idx, sent FROM sentences",
    "tokens": f"""WITH {TOKEN_ROWS}
SELECT doc_id, CAST(sent_idx AS INTEGER) AS sent_idx, CAST(pos AS INTEGER) AS pos, tok FROM tokens""",
    "sentence_stats": f"""WITH {SENTENCE_ROWS},
sized AS (SELECT doc_id, len({TOKENS.format('sent')}) AS k FROM sentences),
counts AS (
  SELECT d.doc_id, count(s.doc_id) AS sentences, CAST(coalesce(sum(s.k), 0) AS BIGINT) AS tokens,
    CASE WHEN {METHOD.format('d.doc_id')} = 'CONSTITUENCY' THEN count(*) FILTER (s.k > 20) ELSE 0 END AS skipped
  FROM documents d LEFT JOIN sized s ON d.doc_id = s.doc_id GROUP BY d.doc_id)
SELECT doc_id, sentences, tokens, skipped, sentences - skipped AS processed FROM counts""",
    "long_sentence_guard": f"""WITH {FETCHED_TAGGED}, trees AS ({_tree('line_no')})
SELECT f.job_id, f.line_no, CAST(t.sent_idx AS INTEGER) AS sent_idx, t.size AS n_tokens,
  CASE WHEN t.size > 20 THEN '[SKIPPED LONG SENTENCE: ' || t.size || ' words]' ELSE t.tree END AS line
FROM ok f JOIN trees t ON f.line_no = t.line_no WHERE f.method = 'CONSTITUENCY'""",
    "annotated_text": f"""WITH {FETCHED_TAGGED},
trees AS ({_tree('line_no')}),
edges AS ({_edges('line_no')}),
blocks AS (
  SELECT line_no, sent_idx, string_agg(edge, chr(10) ORDER BY pos) || chr(10) || chr(10) AS deps
  FROM edges GROUP BY line_no, sent_idx),
tag_lines AS (
  SELECT line_no, sent_idx, string_agg(tok || '/' || tag || ' ', '' ORDER BY pos) || chr(10) AS tags
  FROM tagged GROUP BY line_no, sent_idx),
bodies AS (
  SELECT f.line_no, string_agg(CASE f.method WHEN 'POS' THEN g.tags
      WHEN 'CONSTITUENCY' THEN CASE WHEN t.size > 20 THEN '[SKIPPED LONG SENTENCE: ' || t.size || ' words]' || chr(10)
        ELSE t.tree || chr(10) || chr(10) END
      ELSE b.deps END, '' ORDER BY t.sent_idx) AS body
  FROM ok f JOIN trees t ON f.line_no = t.line_no
    JOIN blocks b ON b.line_no = t.line_no AND b.sent_idx = t.sent_idx
    JOIN tag_lines g ON g.line_no = t.line_no AND g.sent_idx = t.sent_idx
  GROUP BY f.line_no)
SELECT f.job_id, f.line_no, f.method, f.url,
  'workers-results/' || f.job_id || '/' || f.method || '-' || {STEM.format('f.url')} || '-' || f.line_no || '.txt'
    AS output_key,
  coalesce(b.body, '') AS body
FROM ok f LEFT JOIN bodies b ON f.line_no = b.line_no""",
    "tagged_roundtrip": f"""WITH {FETCHED_TAGGED}
SELECT f.job_id, f.line_no, CAST(t.sent_idx AS INTEGER) AS sent_idx, CAST(t.pos AS INTEGER) AS pos, t.tok, t.tag
FROM ok f JOIN tagged t ON f.line_no = t.line_no WHERE f.method = 'POS'""",
    "tree_spans": f"""WITH {TOKEN_ROWS},
flat AS ({_tree('doc_id')}), trees AS ({_chunks()}), {_spans('doc_id')}
SELECT doc_id, sent_idx::INTEGER AS sent_idx, {SPAN_ROW} FROM spans""",
    "tree_rules": f"""WITH {TOKEN_ROWS},
flat AS ({_tree('doc_id')}), trees AS ({_chunks()}), {_spans('doc_id')},
below AS (
  SELECT doc_id, sent_idx, parent AS node, string_agg(label, ' ' ORDER BY node) AS children
  FROM spans WHERE parent IS NOT NULL GROUP BY doc_id, sent_idx, parent)
SELECT label, children, count(*) AS n FROM below JOIN spans USING (doc_id, sent_idx, node) GROUP BY label, children""",
    "tree_scan": f"""WITH {FETCHED_TAGGED},
todo AS (SELECT * FROM tagged WHERE line_no IN (SELECT line_no FROM ok WHERE method = 'CONSTITUENCY')),
trees AS (SELECT line_no, sent_idx, tree FROM ({_tree('line_no', 'todo')}) WHERE size <= 20), {_spans('line_no')}
SELECT line_no, sent_idx::INTEGER AS sent_idx, {SPAN_ROW} FROM spans""",
    "sentences_learned": r"""WITH pieces AS (
  SELECT doc_id, regexp_extract_all(text, '[^\t\n\x0b\x0c\r ]+') AS ps FROM documents),
bare AS (
  SELECT doc_id, i, ps[i] AS piece, regexp_replace(ps[i], '^[^\p{L}\p{N}]+', '') AS b, len(ps) AS size
  FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM pieces)),
x AS MATERIALIZED (
  SELECT doc_id, i, piece, size, lower(regexp_replace(b, '[^\p{L}\p{N}]+$', '')) AS word,
    regexp_extract(piece, '([.!?]+)["'')\]»”’]*$', 1) AS marks, b[1] <> lower(b[1]) AS capital, b[1] <> upper(b[1]) AS small
  FROM bare),
counts AS (
  SELECT word, count(*)::DOUBLE AS n, count(*) FILTER (marks = '.') AS k FROM x
  WHERE regexp_matches(word, '^\p{L}+(\.\p{L}+)*$') GROUP BY word),
whole AS (SELECT sum(k) / sum(n) AS p FROM counts),
short AS (
  SELECT word, (k * ln(0.99::DOUBLE / p) + (n - k) * ln((1 - 0.99::DOUBLE) / (1 - p)))
    * exp(-length(replace(word, '.', ''))::DOUBLE) * (length(word) - length(replace(word, '.', '')) + 1) AS score
  FROM counts, whole WHERE k > 0 AND p > 0 AND p < 1),
abbreviations AS MATERIALIZED (SELECT word FROM short WHERE score >= 0.3),
y AS MATERIALIZED (
  SELECT *, word IN (SELECT word FROM abbreviations) AS short, lead(word) OVER w AS next_word, lead(capital) OVER w AS next_capital,
    lead(small) OVER w AS next_small FROM x WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
first AS (
  SELECT *, CASE WHEN marks = '' THEN false WHEN contains(marks, '!') OR contains(marks, '?') THEN true
    WHEN marks <> '.' THEN NOT next_small WHEN length(word) = 1 AND capital THEN false WHEN short THEN false
    ELSE NOT (regexp_matches(word, '^[0-9]+$') AND next_small) END AS ends FROM y),
follows AS (
  SELECT word, coalesce(lag(ends) OVER (PARTITION BY doc_id ORDER BY i), false) AND capital AS begins FROM first),
starts AS (
  SELECT word, count(*)::DOUBLE AS n, (count(*) FILTER (begins))::DOUBLE AS k FROM follows
  WHERE regexp_matches(word, '^\p{L}+(\.\p{L}+)*$') GROUP BY word),
chance AS (SELECT sum(k) / sum(n) AS p FROM starts),
ratios AS (
  SELECT word, 2 * (k * ln((k / n) / p) + CASE WHEN n = k THEN 0 ELSE (n - k) * ln((1 - k / n) / (1 - p)) END) AS score
  FROM starts, chance WHERE k > 0 AND k / n > p),
starters AS MATERIALIZED (SELECT word FROM ratios WHERE score >= 30),
z AS (
  SELECT doc_id, i, piece, i = size OR CASE WHEN marks = '' THEN false WHEN contains(marks, '!') OR contains(marks, '?') THEN true
    WHEN marks <> '.' THEN NOT next_small WHEN length(word) = 1 AND capital THEN false
    WHEN short THEN next_capital AND next_word IN (SELECT word FROM starters)
    ELSE NOT (regexp_matches(word, '^[0-9]+$') AND next_small) END AS ends FROM y),
n AS (SELECT *, coalesce(sum(ends::INTEGER) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM z)
SELECT doc_id, s::INTEGER AS sent_idx, string_agg(piece, ' ' ORDER BY i) AS sent FROM n GROUP BY doc_id, s""",
    "pos_viterbi": _viterbi(),
    "pos_tags": f"""WITH {TOKEN_ROWS},
counts AS (SELECT lower(tok) AS w, tag, count(*) AS n FROM tagged GROUP BY 1, 2),
lexicon AS (
  SELECT w, tag, sum(n) OVER (PARTITION BY w) AS total,
    row_number() OVER (PARTITION BY w ORDER BY n DESC, tag) AS r FROM counts)
SELECT t.doc_id, CAST(t.sent_idx AS INTEGER) AS sent_idx, CAST(t.pos AS INTEGER) AS pos, t.tok,
  coalesce(l.tag, t.tag) AS tag
FROM tagged t LEFT JOIN lexicon l ON lower(t.tok) = l.w AND l.r = 1 AND l.total >= 5""",
    "annotate_custom": f"""WITH {SENTENCE_ROWS}
SELECT doc_id, CAST(sent_idx AS INTEGER) AS sent_idx,
  CASE WHEN NOT regexp_matches(sent, '[0-9]') THEN CAST(len(string_split(sent, ' ')) AS VARCHAR) END AS value,
  CASE WHEN regexp_matches(sent, '[0-9]') THEN '[ERROR: digit in sentence]' END AS error
FROM sentences""",
    "tag_counts": f"WITH {TOKEN_ROWS} SELECT tag, count(*) AS n FROM tagged GROUP BY tag",
    "tag_bigrams": f"""WITH {TOKEN_ROWS},
p AS (SELECT tag AS tag1, lead(tag) OVER (PARTITION BY doc_id, sent_idx ORDER BY pos) AS tag2 FROM tagged)
SELECT tag1, tag2, count(*) AS n FROM p WHERE tag2 IS NOT NULL GROUP BY tag1, tag2""",
    "tag_lexicon": f"""WITH {TOKEN_ROWS},
counts AS (SELECT lower(tok) AS w, tag, count(*) AS n FROM tagged GROUP BY 1, 2),
ranked AS (
  SELECT w, tag, n, CAST(sum(n) OVER (PARTITION BY w) AS BIGINT) AS total, count(*) OVER (PARTITION BY w) AS n_tags,
    row_number() OVER (PARTITION BY w ORDER BY n DESC, tag) AS r FROM counts)
SELECT w, tag, n, total, n_tags FROM ranked WHERE r = 1""",
    "tree_label_counts": f"""WITH {TOKEN_ROWS}
SELECT label, count(*) AS n FROM (
  SELECT tag AS label FROM tagged
  UNION ALL SELECT unnest(['ROOT', 'S']) FROM (SELECT DISTINCT doc_id, sent_idx FROM tagged)) GROUP BY label""",
    "tree_tag_words": f"""WITH {TOKEN_ROWS}
SELECT tag, CASE tok WHEN '(' THEN '-LRB-' WHEN ')' THEN '-RRB-' ELSE tok END AS word, count(*) AS n
FROM tagged GROUP BY 1, 2""",
    "dep_edge_counts": f"""WITH {TOKEN_ROWS},
heads AS (
  SELECT CASE WHEN pos = size - 1 THEN 'root' ELSE {_relation()} END AS rel,
    coalesce(lead(tok) OVER (PARTITION BY doc_id, sent_idx ORDER BY pos), 'ROOT') AS head, tok AS dep
  FROM tagged)
SELECT rel, head, dep, count(*) AS n FROM heads GROUP BY rel, head, dep""",
    "dedup_completions": f"WITH {COMPLETIONS} SELECT * FROM once",
    "job_progress": f"WITH {PROGRESS} SELECT * FROM progress",
    "orphan_completions": "SELECT event_id AS msg_id, user_id AS job_id FROM events WHERE user_id % 10 = 9",
    "completed_jobs": f"WITH {PROGRESS} SELECT job_id, total, done FROM progress WHERE complete",
    "pending_tasks": f"""WITH {PROGRESS}
SELECT job_id, CAST(sum(remaining) AS BIGINT) AS pending FROM progress GROUP BY ROLLUP (job_id)""",
    "needed_workers": f"""WITH {MANIFEST},
sized AS (
  SELECT job_id, count(*) FILTER (line_no % 3 = 0) AS remaining, CAST(substr(job_id, 4) AS INTEGER) % 4 AS n
  FROM tasks GROUP BY job_id),
total AS (
  SELECT CAST(sum(remaining) AS BIGINT) AS pending,
    CAST(sum(ceil(remaining / CASE WHEN n > 0 THEN n ELSE 1 END)) AS BIGINT) AS wanted FROM sized)
SELECT pending, wanted, greatest(0, least(wanted, 18)) AS target FROM total""",
    "farm_status": f"""WITH {PROGRESS},
total AS (
  SELECT count(*) FILTER (NOT complete) AS active_jobs, CAST(sum(remaining) AS BIGINT) AS pending,
    coalesce(max(n) FILTER (NOT complete), 1) AS max_n, CAST(sum(need) AS BIGINT) AS wanted FROM progress)
SELECT *, greatest(0, least(wanted, 10)) AS target, CAST(10 AS BIGINT) AS cap FROM total""",
    "need_trajectory": f"""WITH {COMPLETIONS},
numbered AS (
  SELECT o.job_id, o.msg_id, o.ts, row_number() OVER (PARTITION BY o.job_id ORDER BY o.ts, o.msg_id) AS done,
    j.total, j.n
  FROM once o JOIN jobs j ON o.job_id = j.job_id),
needs AS (
  SELECT *, total - done AS remaining, CAST(ceil((total - done) / n) AS BIGINT) AS need,
    CAST(ceil(total / n) AS BIGINT) AS first_need FROM numbered)
SELECT job_id, msg_id, ts, done, remaining, need,
  need - coalesce(lag(need) OVER (PARTITION BY job_id ORDER BY done), first_need) AS delta FROM needs""",
    "completion_times": f"""WITH {COMPLETIONS},
numbered AS (
  SELECT o.job_id, o.ts, row_number() OVER (PARTITION BY o.job_id ORDER BY o.ts, o.msg_id) AS done, j.total
  FROM once o JOIN jobs j ON o.job_id = j.job_id)
SELECT job_id, total, ts AS completed_at FROM numbered WHERE done = total""",
    "capacity_plan": f"""WITH {COMPLETIONS},
counts AS (SELECT job_id, date_trunc('hour', ts) AS bucket, count(*) AS k FROM once GROUP BY 1, 2),
upto AS (
  SELECT c.bucket, c.k, j.total, j.n, sum(c.k) OVER (PARTITION BY c.job_id ORDER BY c.bucket) AS done
  FROM counts c JOIN jobs j ON c.job_id = j.job_id),
changes AS (
  SELECT bucket, sum(ceil(greatest(total - done, 0) / n) - ceil(greatest(total - done + k, 0) / n)) AS change
  FROM upto GROUP BY bucket),
wishes AS (
  SELECT bucket, CAST((SELECT sum(ceil(total / n)) FROM jobs) + sum(change) OVER (ORDER BY bucket) AS BIGINT) AS wanted
  FROM changes),
targets AS (SELECT bucket, wanted, greatest(0, least(wanted, 10)) AS target FROM wishes),
steps AS (SELECT *, coalesce(lag(target) OVER (ORDER BY bucket), 0) AS previous FROM targets)
SELECT bucket, wanted, target,
  CASE WHEN target > previous THEN 'up' WHEN target < previous THEN 'down' ELSE 'hold' END AS action FROM steps""",
    "timeout_flags": """WITH gaps AS (
  SELECT event_id, user_id,
    (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) // 1000000 AS duration_s,
    greatest(10, user_id % 5 * 14400 - 10) AS budget_s
  FROM events)
SELECT *, coalesce(duration_s > budget_s, FALSE) AS timed_out,
  CASE WHEN duration_s > budget_s THEN 'Task Timed Out' END AS error FROM gaps""",
    "idle_sessions": """WITH steps AS (
  SELECT user_id, ts, event_id, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < 1800000000 THEN 0 ELSE 1 END AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM steps),
sessions AS (
  SELECT user_id, s, min(ts) AS session_start, max(ts) AS last_event, count(*) AS n_events
  FROM numbered GROUP BY user_id, s)
SELECT user_id, session_start, last_event, n_events,
  (epoch_us(lead(session_start) OVER (PARTITION BY user_id ORDER BY s)) - epoch_us(last_event)) // 60000000
    AS idle_minutes
FROM sessions""",
    "derived_stopwords": f"WITH {STOP} SELECT lang, w, df, CAST(rank AS INTEGER) AS rank FROM stop",
    "stopword_scan": f"WITH {STOP} SELECT lang, w FROM stop",
    "content_tokens": f"""WITH {STOP}
SELECT doc_id, lang, CAST(pos AS INTEGER) AS pos, w FROM words t
WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.lang = t.lang AND s.w = t.w)""",
    "term_frequency": f"""WITH {WORD_ROWS}
SELECT lang, w, count(*) AS tf, count(DISTINCT doc_id) AS df FROM words GROUP BY lang, w""",
    "bigram_counts": f"WITH {BIGRAMS} SELECT lang, w1, w2, n FROM bigrams",
    "collocations": f"""WITH {BIGRAMS},
k AS (
  SELECT lang, w1, w2, n, CAST(n AS DOUBLE) AS k11,
    CAST(sum(n) OVER (PARTITION BY lang, w1) AS DOUBLE) AS c1,
    CAST(sum(n) OVER (PARTITION BY lang, w2) AS DOUBLE) AS c2,
    CAST(sum(n) OVER (PARTITION BY lang) AS DOUBLE) AS total
  FROM bigrams),
scored AS (
  SELECT lang, w1, w2, n, round(2 * (
    ({_xlogx('k11')}) + ({_xlogx('(c1 - k11)')}) + ({_xlogx('(c2 - k11)')}) + ({_xlogx('(total - c1 - c2 + k11)')})
    - (({_xlogx('c1')}) + ({_xlogx('(total - c1)')})) - (({_xlogx('c2')}) + ({_xlogx('(total - c2)')}))
    + ({_xlogx('total')})), 3) AS llr FROM k WHERE n >= 5),
best AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY llr DESC, w1, w2) AS rank FROM scored)
SELECT lang, w1, w2, n, llr, CAST(rank AS INTEGER) AS rank FROM best WHERE rank <= 500""",
    "pair_scan": f"WITH {TEMPLATES} SELECT * FROM templates",
    "pair_files": f"WITH {TEMPLATES} SELECT p, q, swapped, count(*) AS n FROM templates GROUP BY p, q, swapped",
    "pair_symmetry": f"""WITH {TEMPLATES},
c AS (
  SELECT least(p, q) AS a, greatest(p, q) AS b, swapped, count(*) FILTER (p <= q) AS there, count(*) FILTER (p > q) AS back
  FROM templates GROUP BY 1, 2, 3),
r AS (SELECT *, there > 0 AND (back > 0 OR a = b) AS both_ways FROM c),
d AS (
  SELECT a AS p, b AS q, swapped, there AS n, both_ways FROM r UNION ALL
  SELECT b, a, swapped, back, both_ways FROM r)
SELECT p, q, swapped, n, both_ways AND NOT swapped AS reverse_as_is, both_ways AS reverse_renamed FROM d WHERE n > 0""",
    "similar_templates": f"""WITH {STOP}, {ALL_BIGRAMS},
filled AS (
  SELECT lang, 'Y' AS slot, w1 AS p, w2 AS f, n FROM all_bigrams
  UNION ALL SELECT lang, 'X', w2, w1, n FROM all_bigrams),
mi AS (
  SELECT lang, slot, p, f, n, ln(CAST(n AS DOUBLE) * CAST(sum(n) OVER (PARTITION BY lang, slot) AS DOUBLE)
    / (CAST(sum(n) OVER (PARTITION BY lang, slot, p) AS DOUBLE)
       * CAST(sum(n) OVER (PARTITION BY lang, slot, f) AS DOUBLE))) AS mi
  FROM filled),
feat AS MATERIALIZED (SELECT *, sum(mi) OVER (PARTITION BY lang, slot, p) AS mass FROM mi WHERE mi > 0 AND n >= 5),
ratios AS (
  SELECT a.lang, a.p, b.p AS q, a.slot, sum(a.mi + b.mi) / (max(a.mass) + max(b.mass)) AS ratio
  FROM feat a JOIN feat b ON a.lang = b.lang AND a.slot = b.slot AND a.f = b.f AND a.p <> b.p
  GROUP BY a.lang, a.p, b.p, a.slot),
sims AS (
  SELECT x.lang, x.p, x.q, round(sqrt(x.ratio * y.ratio), 3) AS similarity
  FROM ratios x JOIN ratios y ON y.lang = x.lang AND y.p = x.p AND y.q = x.q AND x.slot = 'X' AND y.slot = 'Y')
SELECT lang, p, row_number() OVER (PARTITION BY lang, p ORDER BY similarity DESC, q)::INTEGER AS rank, q, similarity
FROM sims WHERE similarity >= 0.3 QUALIFY rank <= 5""",
    "path_similarity": f"""WITH {STOP}, {ALL_BIGRAMS},
given AS (
  SELECT a.lang, a.w AS p, b.w AS q FROM stop a JOIN stop b ON a.lang = b.lang AND b.rank = a.rank + 1),
filled AS (
  SELECT lang, 'Y' AS slot, w1 AS p, w2 AS f, n FROM all_bigrams
  UNION ALL SELECT lang, 'X', w2, w1, n FROM all_bigrams),
mi AS (
  SELECT lang, slot, p, f, ln(CAST(n AS DOUBLE) * CAST(sum(n) OVER (PARTITION BY lang, slot) AS DOUBLE)
    / (CAST(sum(n) OVER (PARTITION BY lang, slot, p) AS DOUBLE)
       * CAST(sum(n) OVER (PARTITION BY lang, slot, f) AS DOUBLE))) AS mi
  FROM filled),
feat AS (SELECT *, sum(mi) OVER (PARTITION BY lang, slot, p) AS mass FROM mi WHERE mi > 0),
sims AS (
  SELECT g.lang, g.p, g.q, a.slot, sum(a.mi + b.mi) / (max(a.mass) + max(b.mass)) AS ratio
  FROM given g JOIN feat a ON a.lang = g.lang AND a.p = g.p
    JOIN feat b ON b.lang = g.lang AND b.p = g.q AND b.slot = a.slot AND b.f = a.f
  GROUP BY g.lang, g.p, g.q, a.slot)
SELECT g.lang, g.p, g.q, round(sqrt(coalesce(x.ratio, 0) * coalesce(y.ratio, 0)), 3) AS similarity
FROM given g LEFT JOIN sims x ON x.lang = g.lang AND x.p = g.p AND x.q = g.q AND x.slot = 'X'
  LEFT JOIN sims y ON y.lang = g.lang AND y.p = g.p AND y.q = g.q AND y.slot = 'Y'""",
    "threshold_sweep": f"""WITH scored AS (
  SELECT l.quality AS label, CASE WHEN len({WORDS.format('d.text')}) > 0
    THEN len(list_distinct({WORDS.format('d.text')})) / len({WORDS.format('d.text')}) ELSE 0 END AS score
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
steps AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[]) AS threshold),
c AS (
  SELECT threshold, count(*) FILTER (score >= threshold AND label = 1) AS tp,
    count(*) FILTER (score >= threshold AND label = 0) AS fp, count(*) FILTER (score < threshold AND label = 1) AS fn,
    count(*) FILTER (score < threshold AND label = 0) AS tn
  FROM steps, scored GROUP BY threshold)
SELECT *, CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 4) END AS precision,
  CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 4) END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN round(2 * tp / (2 * tp + fp + fn), 4) END AS f1
FROM c""",
    "summary_scan": f"""WITH {RESULTS},
all_jobs AS (SELECT DISTINCT source AS job_id FROM documents),
totals AS (
  SELECT j.job_id, count(r.job_id) AS total, count(*) FILTER (r.success) AS good
  FROM all_jobs j LEFT JOIN results r ON j.job_id = r.job_id GROUP BY j.job_id),
printed AS (
  SELECT job_id, regexp_replace({HTML_LINE}, '\n$', '') AS line FROM results
  UNION ALL
  SELECT job_id, unnest(['<!DOCTYPE html>', '<html lang="en"><head><meta charset="UTF-8"><title>Results</title></head><body>',
    '<p>Total: ' || total || ' | Success: ' || good || ' | Errors: ' || (total - good) || '</p>', '</body></html>'])
  FROM totals)
SELECT job_id, line, count(*) AS n FROM printed GROUP BY job_id, line""",
    "job_run": f"""WITH {RESULTS},
all_jobs AS (SELECT DISTINCT source AS job_id FROM documents)
SELECT j.job_id, count(r.job_id) AS total, count(*) FILTER (r.success) AS successes
FROM all_jobs j LEFT JOIN results r ON j.job_id = r.job_id AND r.job_id <> 'src0' GROUP BY j.job_id""",
    "document_files": """SELECT 'lang: ' || lang AS folder, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes
FROM documents GROUP BY lang""",
    "annotate_plugged": f"""WITH {FETCHED_TAGGED},
cut AS (SELECT line_no, i, ss[i] AS sent FROM (SELECT line_no, ss, unnest(range(1, len(ss) + 1)) AS i FROM sentence_lists)),
sized AS (SELECT line_no, i, sent, len({TOKENS.format('sent')}) AS k FROM cut),
bodies AS (
  SELECT line_no, string_agg(CASE WHEN k > 20 THEN '[SKIPPED LONG SENTENCE: ' || k || ' words]' || chr(10)
    ELSE '(' || len(string_split(sent, ' ')) || ')' || chr(10) || chr(10) END, '' ORDER BY i) AS body
  FROM sized GROUP BY line_no)
SELECT f.job_id, f.line_no, coalesce(b.body, '') AS body
FROM ok f LEFT JOIN bodies b ON f.line_no = b.line_no WHERE f.method = 'CONSTITUENCY'""",
    "stream_completions": "SELECT user_id AS job_id, count(*) AS done FROM events GROUP BY user_id",
    "stream_dedup": f"WITH {COMPLETIONS} SELECT * FROM once",
    "stream_job_done": f"""WITH {PROGRESS} SELECT job_id, total FROM progress WHERE complete""",
    "stream_sessions": """WITH steps AS (
  SELECT user_id, ts, event_id, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < 1800000000 THEN 0 ELSE 1 END AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM steps)
SELECT user_id, min(ts) AS session_start, max(ts) AS last_event, count(*) AS n_events
FROM numbered GROUP BY user_id, s
HAVING max(ts) + INTERVAL 30 MINUTE - INTERVAL 1 MICROSECOND <= date_trunc('millisecond', (SELECT max(ts) FROM events)) - INTERVAL 1 HOUR""",
    "stream_missing_results": f"""WITH {CORRELATED}
SELECT task_id, job_id, sent FROM correlated
WHERE answered IS NULL AND sent + INTERVAL 4 MINUTE < (SELECT w FROM mark)""",
    "stream_responses": f"""WITH {COMPLETIONS}, {CORRELATED}
SELECT task_id, job_id, sent, answered, success FROM correlated
WHERE answered IS NOT NULL AND job_id IN (SELECT job_id FROM jobs WHERE job_id % 2 = 0)""",
    "stream_idle": """WITH steps AS (
  SELECT user_id, ts, event_id, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < 1800000000 THEN 0 ELSE 1 END AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM steps)
SELECT user_id, min(ts) AS active_since, max(ts) AS last_event, max(ts) + INTERVAL 30 MINUTE AS idle_since, count(*) AS n_events
FROM numbered GROUP BY user_id, s
HAVING max(ts) + INTERVAL 30 MINUTE <= date_trunc('millisecond', (SELECT max(ts) FROM events)) - INTERVAL 1 HOUR""",
    "stream_route": f"""WITH {MESSAGES}
SELECT *, CASE WHEN route = 'control' THEN 'control' ELSE 'work' END AS lane FROM routed""",
    "stream_needed_workers": f"""WITH {COMPLETIONS},
done AS (SELECT job_id, count(*) AS done FROM completions GROUP BY job_id),
total AS (
  SELECT CAST(sum(greatest(j.total - d.done, 0)) AS BIGINT) AS pending,
    CAST(sum(ceil(greatest(j.total - d.done, 0) / j.n)) AS BIGINT) AS wanted
  FROM jobs j JOIN done d ON j.job_id = d.job_id)
SELECT pending, wanted, greatest(0, least(wanted, 10)) AS target FROM total""",
}

# the rerun of two jobs had the even lines only
ORACLES["annotated_objects"] = f"""SELECT output_key, body FROM ({ORACLES['annotated_text']})
WHERE NOT (job_id IN ('src1', 'src2') AND line_no % 2 = 1)"""
