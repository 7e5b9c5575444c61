"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

import re

from quarrymill.llm.chat_format import BETWEEN, CLOSE, OPEN
from quarrymill.llm.license_scan import LEAST, TEMPLATES, size_bounds, template_bigrams
from quarrymill.llm.quality_rules import BELIEVED, LEAST_PRIOR, MOST_PRIOR, PRIOR, ROUNDS, RULES

WS = "(chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13))"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^ \t\n\x0B\f\r]+')"
quoted = lambda x: "'" + x.replace("'", "''") + "'"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, u.line AS line, u.pos AS pos, {LOWER.format(f"trim(u.line, {WS})")} AS k
  FROM documents, unnest(string_split(coalesce(text, ''), chr(10))) WITH ORDINALITY AS u(line, pos)
), common AS (
  SELECT k, min(doc_id) AS keeper FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT l.*, c.k IS NOT NULL AND l.doc_id <> c.keeper AS gone FROM lines l LEFT JOIN common c USING (k)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def quality_rules_sql(rounds: int = ROUNDS) -> str:
    n = range(len(RULES))
    vote = lambda r: " ".join(["CASE", *([f"WHEN {r.good} THEN 1"] if r.good else []), *([f"WHEN {r.bad} THEN -1"] if r.bad else []), "ELSE 0 END"])
    share = lambda j, vote, start, p: f"({BELIEVED * start}::DOUBLE + sum(CASE v{j} WHEN {vote} THEN n * {p} ELSE 0 END) OVER ()) / ({BELIEVED}::DOUBLE + sum(n * {p}) OVER ())"
    shares = [(f"{side}{j}_{kind}", share(j, vote, start[k], p)) for j, r in enumerate(RULES) for side, vote, start in (("g", 1, r.good_votes), ("b", -1, r.bad_votes)) for k, (kind, p) in enumerate((("good", "p"), ("bad", "(1 - p)")))]
    prior = f"least({MOST_PRIOR}::DOUBLE, greatest({LEAST_PRIOR}::DOUBLE, ({BELIEVED * PRIOR}::DOUBLE + sum(n * p) OVER ()) / ({BELIEVED}::DOUBLE + sum(n) OVER ()))) AS prior"
    ahead = ", ".join([prior, *[f"{sql} AS {name}" for name, sql in shares]])
    odds = "ln(prior / (1 - prior)) + " + " + ".join(f"CASE v{j} WHEN 1 THEN ln(g{j}_good / g{j}_bad) WHEN -1 THEN ln(b{j}_good / b{j}_bad) ELSE 0 END" for j in n)
    first = f"ln({PRIOR / (1 - PRIOR)}::DOUBLE) + " + " + ".join(f"CASE v{j} WHEN 1 THEN ln({r.good_votes[0] / r.good_votes[1]}::DOUBLE) WHEN -1 THEN ln({r.bad_votes[0] / r.bad_votes[1]}::DOUBLE) ELSE 0 END" for j, r in enumerate(RULES))
    vs = ", ".join(f"v{j}" for j in n)
    return rf"""
WITH RECURSIVE base AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {WS}) <> '') AS lines FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS win FROM base, unnest(range(1, len(w) - 6)) AS u(i)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 8) AS r(k) GROUP BY doc_id
), signals AS (
  SELECT b.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(lines) AS n_lines,
    len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '!')) AS n_bangs, len(regexp_extract_all(text, '[.?!]')) AS n_stops, len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i-1])) AS n_adjacent
  FROM base b LEFT JOIN repeated r USING (doc_id)
), voted AS (SELECT *, {", ".join(f"{vote(r)} AS v{j}" for j, r in enumerate(RULES))} FROM signals
), em AS (
  SELECT 0 AS k, {vs}, count(*)::DOUBLE AS n, 1 / (1 + exp(-({first})::DOUBLE)) AS p FROM voted GROUP BY {vs}
  UNION ALL
  SELECT k + 1, {vs}, n, 1 / (1 + exp(-({odds}))) FROM (SELECT *, {ahead} FROM em WHERE k < {rounds})
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND p >= 0.5 AS kept
FROM voted JOIN (SELECT * FROM em WHERE k = {rounds}) USING ({vs})
"""


def license_scan_sql() -> str:
    known = [(name, g) for name in sorted(TEMPLATES) for t in TEMPLATES[name] if (g := template_bigrams(t))]
    rows = ",\n".join(f"({quoted(name)}, [{', '.join(map(quoted, g))}], {size_bounds(len(g), LEAST)[0]}, {size_bounds(len(g), LEAST)[1]})" for name, g in known)
    return rf"""
WITH templates(name, t, lo, hi) AS (VALUES {rows}
), bounds AS (SELECT min(lo) AS lo, max(hi) AS hi FROM templates
), units AS (
  SELECT doc_id, false AS run, unnest(list_distinct(list_concat(string_split(coalesce(text, ''), chr(10)), string_split_regex(coalesce(text, ''), '\n[ \t\n\x0B\f\r]*\n'), [coalesce(text, '')]))) AS unit FROM documents
), parts AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i, w, sum(len(w)) OVER (PARTITION BY doc_id ORDER BY pos) AS upto
  FROM (SELECT doc_id, pos, regexp_extract_all({LOWER.format("p")}, '[a-z0-9]+') AS w FROM documents, unnest(string_split_regex(coalesce(text, ''), '\n[ \t\n\x0B\f\r]*\n')) WITH ORDINALITY AS u(p, pos)) WHERE len(w) > 0
), runs AS (
  SELECT a.doc_id, flatten(list(c.w ORDER BY c.i)) AS w FROM parts a JOIN parts b ON a.doc_id = b.doc_id AND b.i > a.i AND b.upto - a.upto + len(a.w) BETWEEN (SELECT lo FROM bounds) + 1 AND (SELECT hi FROM bounds) + 1
  JOIN parts c ON c.doc_id = a.doc_id AND c.i BETWEEN a.i AND b.i GROUP BY a.doc_id, a.i, b.i
), worded AS (
  SELECT doc_id, run, regexp_extract_all({LOWER.format("unit")}, '[a-z0-9]+') AS w, unit FROM units UNION ALL SELECT doc_id, true, w, NULL FROM runs
), grams AS (
  SELECT doc_id, run, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1])) AS g FROM worded WHERE len(w) >= 2
), hits AS (
  SELECT doc_id, run, unit, name, 200.0::DOUBLE * len(list_intersect(g, t)) / (len(g) + len(t)) AS score
  FROM grams JOIN templates ON len(g) BETWEEN lo AND hi WHERE 200 * len(list_intersect(g, t)) >= {LEAST} * (len(g) + len(t))
), best AS (
  SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, CASE WHEN count(*) FILTER (WHERE NOT run) > 0 THEN count(DISTINCT unit) FILTER (WHERE NOT run) ELSE 1 END AS n, max(score) AS score FROM hits GROUP BY doc_id
)
SELECT d.doc_id, (SELECT min(h.name) FROM hits h WHERE h.doc_id = d.doc_id AND h.score = b.score) AS license, coalesce(licenses, '') AS licenses,
  round(coalesce(score, 0.0::DOUBLE), 6) AS license_score, coalesce(n, 0)::BIGINT AS n_notices
FROM documents d LEFT JOIN best b USING (doc_id)
"""


NEAR_DEDUP = f"""
WITH RECURSIVE words AS (SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT a, b FROM pairs p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * p.n >= 75 * (x.n + y.n - p.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), lowest AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, d.doc_id) AS component_id, coalesce(c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON lowest.doc_id = d.doc_id
"""

DECONTAMINATE = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents
), bw AS (SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i+9], ' ') AS win FROM bw, unnest(range(1, greatest(len(w) - 8, 2))) AS u(i) WHERE len(w) > 0
), places AS (
  SELECT doc_id, i, k, array_to_string(w[i:i+k-1], ' ') AS win FROM dw, (SELECT DISTINCT k FROM windows), unnest(range(1, len(w) - k + 2)) AS u(i)
), hits AS (SELECT doc_id, i, p.k, item_id FROM places p JOIN windows v USING (k, win)
), words AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT DISTINCT doc_id, i, k FROM hits), unnest(range(0, k)) AS u(j) GROUP BY doc_id
), items AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM hits GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items.s, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items ON items.doc_id = dw.doc_id
"""

mark = lambda x: " || ".join("chr(10)" if p == "\n" else quoted(p) for p in re.split("(\n)", x) if p)
CHAT_FORMAT = f"""
WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), held AS (
  SELECT conv_id, list({{'r': role, 't': text}} ORDER BY turn, role, text) AS x, string_agg({mark(OPEN)} || role || {mark(BETWEEN)} || text || {mark(CLOSE)}, '' ORDER BY turn, role, text) AS rendered
  FROM turns GROUP BY conv_id
), whole AS (SELECT x, min(conv_id) AS conv_id, count(*) AS n, any_value(rendered) AS rendered FROM held GROUP BY x)
SELECT conv_id, len(x)::BIGINT AS n_turns, n::BIGINT AS n_copies, sha256(rendered) AS rendered_sha256 FROM whole a
WHERE NOT EXISTS (SELECT 1 FROM whole b WHERE b.x[1] = a.x[1] AND len(b.x) > len(a.x) AND b.x[1:len(a.x)] = a.x)
"""

sized = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"
leaf_sql = lambda n_chars: "sha256(" + " || ".join(sized(c) for c in ("d.doc_id", "source", "lang", n_chars, "text")) + ")"
MERKLE = f"""
WITH RECURSIVE crc AS (
  SELECT DISTINCT doc_id, doc_id::VARCHAR AS s, 0 AS t, 4294967295::BIGINT AS c FROM documents WHERE doc_id IS NOT NULL UNION ALL
  SELECT doc_id, s, t + 1, xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END) FROM (SELECT doc_id, s, t, CASE WHEN t % 8 = 0 THEN xor(c, ascii(substr(s, t // 8 + 1, 1))::BIGINT) ELSE c END AS c FROM crc WHERE t < 8 * length(s))
), picked AS (SELECT doc_id FROM crc WHERE t = 8 * length(s) AND xor(c, 4294967295::BIGINT) % 7 = 0
), leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, d.doc_id, coalesce('=' || lang, '') AS tree, {leaf_sql("n_chars")} AS leaf, CASE WHEN p.doc_id IS NOT NULL THEN {leaf_sql("(n_chars + 1)")} ELSE {leaf_sql("n_chars")} END AS used
  FROM documents d LEFT JOIN picked p ON p.doc_id = d.doc_id
), placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves
), nodes AS MATERIALIZED (
  SELECT tree, 0 AS k, pos, leaf AS h, n FROM placed UNION ALL
  SELECT tree, k + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY tree, k, pos // 2, n
), subroots AS MATERIALIZED (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), over_nodes AS MATERIALIZED (
  SELECT 0 AS k, pos, h, n FROM subroots UNION ALL
  SELECT k + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM over_nodes WHERE n > 1 GROUP BY k, pos // 2, n
), root AS (SELECT h FROM over_nodes WHERE n = 1
), steps AS MATERIALIZED (
  SELECT p.rid, a.k AS height, s.h AS sibling, (p.pos >> a.k) % 2 = 1 AS onleft FROM placed p JOIN (SELECT DISTINCT tree, k FROM nodes WHERE n > 1) a ON a.tree = p.tree LEFT JOIN nodes s ON s.tree = p.tree AND s.k = a.k AND s.pos = xor(p.pos >> a.k, 1::BIGINT)
  UNION ALL
  SELECT p.rid, 100 + a.k, s.h, (r.pos >> a.k) % 2 = 1 FROM placed p JOIN subroots r ON r.tree = p.tree JOIN (SELECT DISTINCT k FROM over_nodes WHERE n > 1) a ON true LEFT JOIN over_nodes s ON s.k = a.k AND s.pos = xor(r.pos >> a.k, 1::BIGINT)
), ordered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY height) AS step FROM steps
), proofs AS (SELECT rid, max(step) AS n_steps, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM ordered GROUP BY rid
), fold AS (
  SELECT rid, 0::BIGINT AS step, used AS h FROM leaves UNION ALL
  SELECT f.rid, o.step, CASE WHEN o.sibling IS NULL THEN sha256(f.h) WHEN o.onleft THEN sha256(o.sibling || f.h) ELSE sha256(f.h || o.sibling) END FROM fold f JOIN ordered o ON o.rid = f.rid AND o.step = f.step + 1
)
SELECT p.doc_id, p.leaf, r.h AS subroot, root.h AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root.h AS verified
FROM placed p JOIN subroots r ON r.tree = p.tree JOIN root ON true LEFT JOIN proofs q ON q.rid = p.rid JOIN fold f ON f.rid = p.rid AND f.step = coalesce(q.n_steps, 0)
"""

ORACLE_SQL = {
    "op1_line_dedup": LINE_DEDUP,
    "op3_quality_rules": quality_rules_sql(),
    "op5_license_scan": license_scan_sql(),
    "op6_near_dedup": NEAR_DEDUP,
    "op7_decontaminate": DECONTAMINATE,
    "op9_chat_format": CHAT_FORMAT,
    "op13_merkle_manifest": MERKLE,
}
