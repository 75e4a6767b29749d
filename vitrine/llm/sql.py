"""DuckDB SQL of the numbered queries that SQL can express over whole tables.

Not expressed: 2 (byte-pair merges), 5 and 6 (trained models), 7 (the lexer's
spans), the pipeline.
"""

from __future__ import annotations

from vitrine.llm.url_reputation import RULES

#: words of a text, as a list
WORDS = "regexp_extract_all(coalesce({}, ''), '[^\\x20\\x09-\\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_substring_dedup"] = f"""
WITH split AS (SELECT doc_id, {WORDS.format("text")} AS words FROM documents),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM split)),
firsts AS (SELECT w, min(doc_id) AS first_doc FROM windows GROUP BY w),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM windows JOIN firsts USING (w) WHERE first_doc < doc_id),
words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS k FROM split),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text, count(*) AS n FROM words ANTI JOIN covered USING (doc_id, k) GROUP BY doc_id)
SELECT s.doc_id, len(s.words)::BIGINT AS n_words, (len(s.words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM split s LEFT JOIN kept USING (doc_id)
"""

ORACLE_SQL["op3_ngram_jaccard"] = f"""
WITH RECURSIVE split AS (SELECT doc_id, {WORDS.format(_LOWER.format("text"))} AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM split WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce((SELECT min(y) FROM reach WHERE x = doc_id), doc_id)) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id)
"""

ORACLE_SQL["op4_mtree_topk"] = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
    FROM vectors q JOIN vectors x ON q.vec_id <> x.vec_id AND len(q.v) = len(x.v) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 20
"""

ORACLE_SQL["op8_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _rule_case(column: str) -> str:
    arms = []
    for host, path, verdict in sorted(RULES, key=lambda r: (-len(r[0] + r[1]), r)):
        value = {"rule": host + path, "verdict": verdict}[column]
        arms.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{value}'")
    return f"CASE {' '.join(arms)} END"


def _level(name: str, units: str, prior: str, spread: str) -> str:
    """Posterior mean and variance of the units (n outcomes, k blocked) under their parents' mean and variance."""
    return f"""
{name}_fit AS (
    SELECT coalesce(sum(CASE WHEN n > 0 THEN n * pow(k / n - {prior}, 2) END), 0) AS s, coalesce(sum(CASE WHEN n > 0 THEN {prior} * (1 - {prior}) END), 0) AS d,
           coalesce(sum(n * {prior} * (1 - {prior})), 0) AS q FROM {units}),
{name}_weight AS (SELECT least(greatest((1 - rho) / greatest(rho, 1e-9), 0.5), 1e6) AS m FROM (SELECT CASE WHEN q > d AND s > d THEN (s - d) / (q - d) ELSE 0 END AS rho FROM {name}_fit)),
{name}_post AS (
    SELECT u.*, (m * {prior} + k) / (m + n) AS {name}_mean,
           (m * {prior} + k) * (m * (1 - {prior}) + n - k) / ((m + n) * (m + n) * (m + n + 1)) + pow(m / (m + n), 2) * {spread} AS {name}_var
    FROM {units} u, {name}_weight)"""


ORACLE_SQL["op9_url_reputation"] = f"""
WITH seen AS (
    SELECT page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
ruled AS (SELECT *, {_rule_case("rule")} AS rule, {_rule_case("verdict")} AS ruled FROM seen),
hosts AS (SELECT host, regexp_extract(host, '([^.]*\\.)?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix, count(ruled) AS n, count(*) FILTER (ruled = 'block') AS k
          FROM ruled GROUP BY host),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT (sum(k) + 1) / (sum(n) + 2) FROM hosts) AS p, 0.0 AS v FROM hosts GROUP BY suffix),
{_level("suffix", "suffixes", "p", "v")},
domains AS (SELECT domain, suffix, sum(h.n) AS n, sum(h.k) AS k, any_value(suffix_mean) AS suffix_mean, any_value(suffix_var) AS suffix_var
            FROM hosts h JOIN suffix_post USING (suffix) GROUP BY domain, suffix),
{_level("domain", "domains", "suffix_mean", "suffix_var")},
units AS (SELECT host, h.n, h.k, domain_mean, domain_var FROM hosts h JOIN domain_post USING (domain, suffix)),
{_level("host", "units", "domain_mean", "domain_var")}
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN host_mean - 1.645 * sqrt(host_var) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN host_post USING (host)
"""

ORACLE_SQL["op10_entropy_mixing"] = f"""
WITH sizes AS (SELECT doc_id, source, len({WORDS.format("text")})::BIGINT AS size, ('0x' || substr(md5(doc_id::VARCHAR), 1, 12))::BIGINT AS key FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (SELECT *, 2.0::DOUBLE * source_size AS top, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::DOUBLE AS w, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM sources),
stacked AS (SELECT *, coalesce(sum(top) OVER below, 0) AS tops, coalesce(sum(w) OVER below, 0) AS ws, sum(w) OVER () AS all_w
            FROM weighed WINDOW below AS (ORDER BY top / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, w * (total - tops) >= top * (all_w - ws) AS filled FROM stacked),
targets AS (SELECT source, source_size, CASE WHEN filled THEN top ELSE w * (total - sum(CASE WHEN filled THEN top ELSE 0 END) OVER ()) / sum(CASE WHEN filled THEN 0 ELSE w END) OVER () END AS target FROM marked),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-9) ELSE 0 END::BIGINT AS base FROM targets),
rooms AS (SELECT *, greatest(target - base * source_size, 0) AS room FROM rates),
rows_ AS (SELECT s.*, source_size, target, base, room, sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size) AS upto
          FROM sizes s JOIN rooms r ON s.source IS NOT DISTINCT FROM r.source),
taken AS (SELECT *, size > 0 AND room > 0 AND upto <= room AS extra FROM rows_),
gaps AS (SELECT *, room - coalesce(max(CASE WHEN extra THEN upto END) OVER (PARTITION BY source), 0) AS gap FROM taken),
closing AS (SELECT *, NOT extra AND size > 0 AND room > 0 AND size <= 2 * gap AND base + 1 <= 2 AS may_close FROM gaps),
closed AS (SELECT *, may_close AND row_number() OVER (PARTITION BY source, may_close ORDER BY abs(gap - size), key, doc_id, size) = 1 AS closes FROM closing)
SELECT doc_id, size, source_size, target, ((base + (extra OR closes)::INTEGER) * size)::BIGINT AS taken FROM closed
"""

#: CRC-32 of a string of ASCII characters, bit by bit
_CRC_STEP = "list_reduce([{x}] || [0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)"
_CRC = ("xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({}, ''), lambda ch: ascii(ch)::BIGINT), lambda a, b: "
        + _CRC_STEP.format(x="xor(a, b)") + "), 4294967295)")


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _climb(name: str, base: str) -> str:
    """Nodes of all levels: grp, lvl, pos, d, n (nodes of the level)."""
    return f"""
{name}(grp, lvl, pos, d, n) AS (
    SELECT grp, 0, pos, d, n FROM {base}
    UNION ALL SELECT grp, lvl + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY grp, lvl, pos // 2, n)"""


def _fold(name: str, base: str, nodes: str) -> str:
    """acc folded from every row of base (key, grp, pos, acc, path, n) up to its root, and the siblings on the way."""
    return f"""
{name}(key, grp, lvl, pos, acc, path, n) AS (
    SELECT key, grp, 0, pos, acc, path, n FROM {base}
    UNION ALL SELECT key, f.grp, f.lvl + 1, f.pos // 2, sha256(CASE WHEN f.pos % 2 = 0 THEN acc || coalesce(s.d, '') ELSE s.d || acc END), path || coalesce(s.d, ''), (f.n + 1) // 2
    FROM {name} f LEFT JOIN {nodes} s ON s.grp = f.grp AND s.lvl = f.lvl AND s.pos = xor(f.pos, 1) WHERE f.n > 1)"""


ORACLE_SQL["op11_merkle_manifest"] = f"""
WITH RECURSIVE rows_ AS (SELECT row_number() OVER () AS key, *, coalesce('=' || lang, '') AS grp, {_CRC.format("doc_id::VARCHAR")} % 7 = 0 AS tamper FROM documents),
leaves AS (SELECT *, {_leaf("n_chars")} AS d, {_leaf("(n_chars + 1)")} AS bad FROM rows_),
placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, d) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM leaves),
{_climb("nodes", "placed")},
subroots AS (SELECT '' AS grp, grp AS key, d, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_climb("tops", "subroots")},
first_fold AS (SELECT key, grp, pos, CASE WHEN tamper THEN bad ELSE d END AS acc, '' AS path, n FROM placed),
{_fold("folds", "first_fold", "nodes")},
second_fold AS (SELECT f.key, '' AS grp, s.pos, acc, path, s.n FROM folds f JOIN subroots s ON s.key = f.grp WHERE f.n = 1),
{_fold("lasts", "second_fold", "tops")}
SELECT doc_id, p.d AS leaf, s.d AS subroot, r.d AS root, sha256(l.path) AS proof_sha256, l.acc AS folded_root, l.acc = r.d AS verified
FROM placed p JOIN lasts l ON l.key = p.key AND l.n = 1 JOIN subroots s ON s.key = p.grp JOIN tops r ON r.n = 1
"""

_TOKENS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE_SQL["op12_winnowing"] = f"""
WITH docs AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
items AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_TOKENS} AS w FROM benchmark) WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
seen AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM items) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM seen JOIN wins USING (n, win)),
marked AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _assign(name: str, centroids: str) -> str:
    return f"""
{name} AS (SELECT r, vec_id, v, (best & 65535)::INTEGER AS cluster, (best >> 16)::BIGINT AS distance FROM (
    SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min((list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT << 16) | cluster) AS best
    FROM kept CROSS JOIN {centroids} GROUP BY r))"""


def _move(name: str, assigned: str, old: str) -> str:
    return f"""
{name} AS (SELECT cluster, coalesce(m, c) AS c FROM {old} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d) AS m FROM (
        SELECT cluster, d, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM {assigned}) GROUP BY cluster, d)
    GROUP BY cluster) USING (cluster))"""


ORACLE_SQL["op13_sharded_lloyd"] = f"""
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1)::BIGINT AS cluster, v AS c FROM kept QUALIFY cluster < 16),
{_assign("a0", "c0")}, {_move("c1", "a0", "c0")}, {_assign("a1", "c1")}, {_move("c2", "a1", "c1")}, {_assign("a2", "c2")}, {_move("c3", "a2", "c2")}, {_assign("a3", "c3")}
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN c3 USING (cluster)
"""
