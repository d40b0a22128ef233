"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from urbanflow.llm import license_scan, line_dedup, url_filter
from urbanflow.llm.chat import CONTROL
from urbanflow.llm.queries import RULES

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower(x: str) -> str:
    return f"translate({x}, '{UP}', '{LOW}')"


def rule_cases(what: int) -> str:
    cases = []
    for text, says in sorted(RULES, key=lambda r: -len(r[0])):
        own, slash, start = text.partition("/")
        cases.append(f"WHEN (host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '{slash}{start}') THEN '{(text, says)[what]}'")
    return "CASE " + " ".join(cases) + " END"


def level(name: str, rows: str, key: str) -> str:
    """The shrunk rates of one level, whose rows have key, n, s and the parents' mean m."""
    return f"""{name}_in AS ({rows}), {name}_w AS (SELECT CASE WHEN k > 1 AND (spread - b * k / total) / nullif(b, 0) > 0 THEN least(greatest(1 / ((spread - b * k / total) / nullif(b, 0)) - 1, {url_filter.WEAKEST}), {url_filter.STRONGEST}) ELSE {url_filter.STRONGEST} END AS w
FROM (SELECT sum(n) AS total, count(*) AS k, sum(n * (s / n - m) ** 2) AS spread, sum(n * m * (1 - m)) AS b FROM {name}_in WHERE n > 0)),
{name} AS (SELECT {key}, n, s, (s + w * m) / (n + w) AS p, n + w AS weight FROM {name}_in, {name}_w)"""


OP1 = f"""WITH u AS (SELECT page_id, coalesce({lower("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
h0 AS (SELECT host, count(quality) AS n, coalesce(sum(quality), 0)::DOUBLE AS s, string_split(host, '.') AS parts FROM u LEFT JOIN (SELECT doc_id, quality FROM labels WHERE quality IN (0, 1)) ON doc_id = page_id GROUP BY host),
h1 AS (SELECT host, n, s, array_to_string(parts[-2 - two:], '.') AS domain, array_to_string(parts[-1 - two:], '.') AS suffix FROM (SELECT *, CAST(array_to_string(parts[-2:], '.') IN {url_filter.SUFFIXES} AS INT) AS two FROM h0)),
d1 AS (SELECT domain, suffix, sum(n) AS n, sum(s) AS s FROM h1 GROUP BY ALL), s1 AS (SELECT suffix, sum(n) AS n, sum(s) AS s FROM d1 GROUP BY ALL), whole AS (SELECT coalesce(sum(s) / nullif(sum(n), 0), 0.5) AS m FROM s1),
{level("sfx", "SELECT suffix, n, s, m FROM s1, whole", "suffix")},
{level("dom", "SELECT domain, d1.n, d1.s, p AS m FROM d1 JOIN sfx USING (suffix)", "domain")},
{level("hst", "SELECT host, h1.n, h1.s, p AS m FROM h1 JOIN dom USING (domain)", "host")},
r AS (SELECT host, p, p - {url_filter.Z} * sqrt(p * (1 - p) / (weight + 1)) AS bound, n FROM hst)
SELECT page_id, host, path, {rule_cases(0)} AS rule, coalesce({rule_cases(1)}, CASE WHEN bound >= {url_filter.MIN_SHARE} * m THEN 'allow' ELSE 'block' END) AS verdict, round(p, 6) AS mean, round(bound, 6) AS bound, n AS n_labelled FROM u JOIN r USING (host), whole"""


def quoted(x: str) -> str:
    return f"regexp_replace({x}, '([<\\[])(\\\\*)({CONTROL})', '\\1\\\\\\2\\3', 'g')"


OP3 = f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)),
f AS (SELECT *, CASE role WHEN 'user' THEN '<s>[INST] ' || {quoted('text')} || ' [/INST]' WHEN 'system' THEN '<s><<SYS>> ' || {quoted('text')} || ' <</SYS>>' WHEN 'assistant' THEN '<s>' || {quoted('text')} || '</s>'
ELSE '<s><|role|>' || {quoted('role')} || '<|text|>' || {quoted('text')} || '</s>' END AS formatted FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, formatted)) AS turns_sha256,
coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(length(formatted))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id"""

TEMPLATES = ", ".join(f"({i}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')" for i, (k, v) in enumerate(license_scan.flat(license_scan.TEMPLATES)))
N = len(license_scan.flat(license_scan.TEMPLATES))


def words(x: str) -> str:
    return f"list_filter(regexp_extract_all({lower(x)}, '({license_scan.WORD})', 1), lambda w: NOT list_contains({license_scan.STOP}, w))"


#: Every unit of every text is scored here, without the bound by which the operator leaves some out.
OP4 = f"""WITH t AS (SELECT * FROM (VALUES {TEMPLATES}) AS t(i, template, body)), tf AS (SELECT i, word, count(*) AS tf FROM (SELECT i, unnest({words('body')}) AS word FROM t) GROUP BY ALL),
idf AS (SELECT word, ln((1 + {N}) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY word), tn AS (SELECT i, sqrt(sum((tf * idf) ** 2)) AS norm FROM tf JOIN idf USING (word) GROUP BY i),
tw AS (SELECT i, word, tf * idf / norm AS tw FROM tf JOIN idf USING (word) JOIN tn USING (i)),
bl AS (SELECT doc_id, string_split_regex(text, '{license_scan.BLANK}') AS parts FROM documents),
l AS (SELECT doc_id, 1 AS kind, unnest(range(len(string_split(text, chr(10)))))::INT AS place, unnest(string_split(text, chr(10))) AS body FROM documents
UNION ALL SELECT doc_id, 2, place, body FROM (SELECT doc_id, unnest(range(len(parts)))::INT AS place, unnest(parts) AS body FROM bl) WHERE contains(body, chr(10)) UNION ALL SELECT doc_id, 3, 0, text FROM documents WHERE contains(text, chr(10))),
w AS (SELECT doc_id, kind, place, word, count(*) AS tf FROM (SELECT doc_id, kind, place, unnest({words('body')}) AS word FROM l) GROUP BY ALL),
ww AS (SELECT doc_id, kind, place, word, tf * coalesce(idf, ln(1 + {N}) + 1) AS w FROM w LEFT JOIN idf USING (word)), nn AS (SELECT doc_id, kind, place, sqrt(sum(w * w)) AS norm FROM ww GROUP BY ALL),
c AS (SELECT doc_id, kind, place, template, round(sum(w * tw) / any_value(norm), 6) AS cosine FROM ww JOIN tw USING (word) JOIN t USING (i) JOIN nn USING (doc_id, kind, place) GROUP BY doc_id, kind, place, i, template
UNION ALL SELECT doc_id, 0, 0, regexp_extract(text, '{license_scan.SPDX}', 1), 1.0 FROM documents WHERE regexp_extract(text, '{license_scan.SPDX}', 1) <> ''),
own AS (SELECT doc_id, template AS license, cosine, ['spdx', 'line', 'block', 'text'][kind + 1] AS kind, place FROM c WHERE cosine >= {license_scan.MIN_COSINE} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, kind, place, template) = 1),
p AS (SELECT doc_id, concat_ws('/', source, CASE WHEN doc_id % 100 <> 0 THEN lang END, CASE WHEN doc_id % 10 <> 0 THEN 'shelf' || (doc_id // 500) END, CAST(doc_id AS VARCHAR)) AS path FROM documents),
r AS (SELECT p.*, regexp_replace(path, '/[^/]*$', '') AS dir, license, cosine, kind, place FROM p LEFT JOIN own USING (doc_id)),
held AS (SELECT dir AS up, arg_min(license, doc_id) AS up_license FROM r WHERE license IS NOT NULL GROUP BY dir),
near AS (SELECT d.dir, arg_max(up, length(up)) AS from_dir, arg_max(up_license, length(up)) AS dir_license FROM (SELECT DISTINCT dir FROM r) d JOIN held ON d.dir = up OR starts_with(d.dir, up || '/') GROUP BY d.dir)
SELECT doc_id, path, coalesce(license, dir_license) AS license, CASE WHEN license IS NOT NULL THEN 'own' WHEN dir_license IS NOT NULL THEN 'directory' END AS origin, CASE WHEN license IS NULL THEN from_dir END AS from_dir, cosine, kind, place FROM r LEFT JOIN near USING (dir)"""


def plain_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({lower(x)}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"


OP5 = f"""WITH d AS (SELECT doc_id, coalesce({plain_words('text')}, []) AS w FROM documents), b AS (SELECT item_id, {plain_words('text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS span, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, span, array_to_string(w[i:i + span - 1], ' ') AS win FROM (SELECT doc_id, w, span, unnest(range(1, len(w) - span + 2)) AS i FROM d, (SELECT DISTINCT span FROM bw))),
h AS (SELECT doc_id, i, span, item_id FROM dw JOIN bw USING (span, win)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + span)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)"""

OP8 = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lower('text')}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) USING (doc_id)"""

OP10 = f"""WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, source, unnest(range(len(parts)))::INT AS pos, trim(regexp_replace(unnest(parts), '^\\s+|\\s+$', '', 'g')) AS line FROM d),
bad AS (SELECT line, min({{'d': doc_id, 'p': pos}}) AS f FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}),
g AS (SELECT doc_id, list(DISTINCT pos ORDER BY pos) AS gone FROM l JOIN bad USING (line) WHERE doc_id <> f.d OR pos <> f.p GROUP BY doc_id),
c AS (SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(parts, lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS text, coalesce(gone, []) AS gone FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, text, len(gone) AS n_removed, array_to_string(gone, ',') AS removed, len(gone) > 0 AND trim(regexp_replace(text, '\\s+', '', 'g')) = '' AS emptied FROM c"""

ORACLES = {"op1_url_filter": OP1, "op3_chat": OP3, "op4_license_scan": OP4, "op5_decontaminate": OP5, "op8_jaccard_join": OP8, "op10_line_dedup": OP10}
