"""The same results in SQL, for queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op8_redirect_url_filter"] = r"""
WITH RECURSIVE rules(verdict, host, path) AS (VALUES
    ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
split AS (
    SELECT page_id, url, html,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest
    FROM pages),
named AS (
    SELECT page_id, url, html, rest,
        coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
        coalesce(regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1), '') AS query
    FROM split),
linked AS (
    SELECT host || path || query AS a, regexp_extract(
        regexp_extract(html, '(?is)<link\s[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'),
        '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS link
    FROM named WHERE rest IS NOT NULL),
ends AS (
    SELECT a, CASE WHEN strpos(link, '://') > 0 THEN substr(link, strpos(link, '://') + 3) END AS b
    FROM linked WHERE link <> ''),
edges AS (
    SELECT a, translate(regexp_extract(b, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') || regexp_extract(b, '^[^/?#]*([^#]*)', 1) AS b
    FROM ends WHERE b IS NOT NULL),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (
    SELECT a, b FROM both_ways
    UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
nodes AS (
    SELECT DISTINCT b AS node, regexp_extract(b, '^[^/?#]*') AS host,
        regexp_extract(b, '^[^/?#]*([^?#]*)', 1) AS path FROM reach),
ruled AS (
    SELECT n.*, r.host || r.path AS rule, r.verdict, row_number() OVER (
        PARTITION BY n.host, n.path ORDER BY length(r.host || r.path) DESC) AS k
    FROM (SELECT DISTINCT host, path FROM named UNION SELECT host, path FROM nodes) n
    JOIN rules r ON (n.host = r.host OR ends_with(n.host, '.' || r.host))
        AND starts_with(n.path, r.path)),
best AS (SELECT * FROM ruled WHERE k = 1),
tainted AS (
    SELECT DISTINCT reach.a AS node FROM reach JOIN nodes ON reach.b = nodes.node
    JOIN best ON best.host = nodes.host AND best.path = nodes.path WHERE best.verdict = 'block')
SELECT p.page_id, p.host, p.path, best.rule,
    coalesce(best.verdict, CASE WHEN t.node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM named p LEFT JOIN best ON best.host = p.host AND best.path = p.path
LEFT JOIN tainted t ON p.rest IS NOT NULL AND t.node = p.host || p.path || p.query
"""

SQL["op9_hash_threshold_mixing"] = r"""
WITH sized AS (
    SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
    FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, 2.0 * source_size AS ceiling, [5.0, 2.0, 1.0][
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
    FROM sources),
levels AS (
    SELECT *, row_number() OVER (ORDER BY ceiling / weight, source NULLS LAST) AS k,
        (1.5 * sum(source_size) OVER () - coalesce(sum(ceiling) OVER (
            ORDER BY ceiling / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / sum(weight) OVER (ORDER BY ceiling / weight, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed),
goal AS (
    SELECT source, source_size, coalesce(least(ceiling, weight * (
        SELECT arg_min(level, k) FROM levels WHERE level * weight < ceiling)), ceiling)::DOUBLE AS target
    FROM levels),
passes AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
    FROM goal),
same AS (SELECT source, hash, sum(size) AS amount FROM sized GROUP BY ALL),
running AS (
    SELECT *, sum(amount) OVER (PARTITION BY source ORDER BY hash) AS run FROM same),
extra AS (
    SELECT r.source, r.hash FROM running r JOIN passes p ON r.source IS NOT DISTINCT FROM p.source
    CROSS JOIN LATERAL (SELECT p.target - p.epochs * p.source_size AS rest)
    WHERE run <= rest OR run - amount <= rest AND run - rest < rest - (run - amount))
SELECT s.doc_id, s.size, p.source_size, p.target,
    p.epochs + (e.hash IS NOT NULL)::BIGINT AS copies,
    s.size * (p.epochs + (e.hash IS NOT NULL)::BIGINT) AS taken
FROM sized s JOIN passes p ON s.source IS NOT DISTINCT FROM p.source
LEFT JOIN extra e ON e.source IS NOT DISTINCT FROM s.source AND e.hash = s.hash
"""

SQL["op7_histogram_top_k"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
    WHERE a.vec_id % 50 = 0)
SELECT query_id,
    (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
    vec_id, score
FROM scores QUALIFY rank <= 5
"""

SQL["op4_cross_polytope_vectors"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least_reached AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links,
    least(e.vec_id, coalesce(r.low, e.vec_id)) AS component_id,
    e.vec_id = least(e.vec_id, coalesce(r.low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN least_reached r ON r.a = e.vec_id
"""

SQL["op10_densified_minhash"] = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] ELSE list_transform(
        range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
both_have AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM both_have p JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b
    WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)),
reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_reached AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles,
    least(d.doc_id, coalesce(r.low, d.doc_id)) AS component_id,
    d.doc_id = least(d.doc_id, coalesce(r.low, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least_reached r ON r.a = d.doc_id
"""

#: Unsigned crc32 of column ``{}`` as text, by a table of 256 entries made by its rule.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
    string_split({0}, ''), lambda c: ascii(c)::BIGINT)), lambda acc, b:
    xor(acc >> 8, crc.entries[(xor(acc, b) & 255) + 1])))"""
_CRC_TABLE = """crc AS (
    SELECT list(entry ORDER BY i) AS entries FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS entry
        FROM range(256) r(i)))"""


def _said(*values: str) -> str:
    return " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values)


def _tree(name: str, start: str, group: str) -> str:
    """Nodes of all levels, each with its siblings before and after."""
    run = f"PARTITION BY height, {group}, rank // 8 ORDER BY rank ROWS BETWEEN"
    return f"""{name}(height, {group}, rank, n, digest) AS (
    {start}
    UNION ALL SELECT height + 1, {group}, rank // 8, (n + 7) // 8,
        sha256(string_agg(digest, '' ORDER BY rank))
    FROM {name} WHERE n > 1 GROUP BY height, {group}, rank // 8, n),
{name}_runs AS (
    SELECT *, coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {name})"""


SQL["op11_merkle_manifest"] = f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
    SELECT doc_id, lang,
        sha256({_said("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", "text")}) AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {_CRC.format("doc_id::VARCHAR")} % 3 = 0
            THEN sha256({_said("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", "lowered")})
        END AS tampered
    FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
        AS lowered FROM documents), crc),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
        count(*) OVER (PARTITION BY lang) AS n
    FROM leaves),
{_tree("nodes", "SELECT 0, lang, rank, n, leaf FROM placed", "lang")},
langs AS (
    SELECT 0 AS everything, lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank,
        count(*) OVER () AS n
    FROM nodes WHERE n = 1),
{_tree("tops", "SELECT 0, everything, rank, n, digest FROM langs", "everything")},
climb(lang, leaf_rank, height, rank, acc, proof) AS (
    SELECT lang, rank, 0, rank, coalesce(tampered, leaf), '' FROM placed
    UNION ALL SELECT c.lang, c.leaf_rank, c.height + 1, c.rank // 8, sha256(s.l || c.acc || s.r),
        c.proof || s.l || s.r
    FROM climb c JOIN nodes_runs s ON s.height = c.height AND s.lang IS NOT DISTINCT FROM c.lang
        AND s.rank = c.rank WHERE s.n > 1),
atop AS (SELECT DISTINCT ON (lang, leaf_rank) * FROM climb ORDER BY lang, leaf_rank, height DESC),
climb_on(lang, leaf_rank, height, rank, acc, proof) AS (
    SELECT a.lang, a.leaf_rank, 0, g.rank, a.acc, a.proof
    FROM atop a JOIN langs g ON g.lang IS NOT DISTINCT FROM a.lang
    UNION ALL SELECT c.lang, c.leaf_rank, c.height + 1, c.rank // 8, sha256(s.l || c.acc || s.r),
        c.proof || s.l || s.r
    FROM climb_on c JOIN tops_runs s ON s.height = c.height AND s.rank = c.rank WHERE s.n > 1),
reached AS (
    SELECT DISTINCT ON (lang, leaf_rank) * FROM climb_on ORDER BY lang, leaf_rank, height DESC)
SELECT p.doc_id, p.leaf, g.digest AS subroot, t.digest AS root, sha256(e.proof) AS proof_sha256,
    e.acc AS folded_root, e.acc = t.digest AS verified
FROM placed p JOIN reached e ON e.lang IS NOT DISTINCT FROM p.lang AND e.leaf_rank = p.rank
JOIN langs g ON g.lang IS NOT DISTINCT FROM p.lang
JOIN (SELECT digest FROM tops WHERE n = 1) t ON true
"""


def _edit(state: str, cost: str, letter: str, line: str = "") -> str:
    said = f"{state}.t || chr(10) || {line}" if line else f"{state}.t"
    return (
        f"CASE WHEN {state} IS NOT NULL THEN "
        f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {said}}} END"
    )


def _insert(state: str, role: str) -> str:
    return _edit(state, "2", "I", f"'{role}:'")


def _take(state: str, initial: str, role: str) -> str:
    """The row as ``role``: kept if it has that initial, else reroled."""
    return (
        f"CASE WHEN fault IN (1, 2) THEN NULL WHEN i = '{initial}' THEN "
        + _edit(state, "cut", "K", "role || ':' || text")
        + " ELSE " + _edit(state, "(2 + cut)", "R", f"'{role}:' || text") + " END"
    )


# states of (s?(ua)+)?: 0 nothing yet, 1 behind s, 2 behind u, 3 behind a
SQL["op13_lr_conversation_repair"] = rf"""
WITH RECURSIVE {_CRC_TABLE},
said AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations),
kinds AS (SELECT said.*, {_CRC.format("key")} % 20 AS kind FROM said, crc),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
            ELSE text END AS text,
        unnest(CASE WHEN kind = 0 THEN [] WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS time
    FROM kinds),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id
            ORDER BY turn NULLS FIRST, role, md5(text), time) AS k,
        left(role, 1) AS i, regexp_extract(text, '(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS solid
    FROM damaged),
judged AS (
    SELECT *, CASE WHEN solid = '' THEN 1
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 2
            WHEN solid NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
        (k > 1 AND coalesce(lag(i) OVER (PARTITION BY conv_id ORDER BY k), '') || i
            NOT IN ('su', 'ua', 'au'))::BIGINT AS odd
    FROM ordered),
coded AS (SELECT *, CASE WHEN fault = 3 THEN 1 ELSE 0 END AS cut FROM judged),
start AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS k, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0 FROM conversations),
walk(conv_id, k, s0, s1, s2, s3) AS (
    SELECT conv_id, k, s0, CASE WHEN k < 0 THEN s0 END, CASE WHEN k < 0 THEN s0 END,
        CASE WHEN k < 0 THEN s0 END
    FROM start
    UNION ALL
    SELECT conv_id, k, {_edit("s0", "3", "D")},
        least({_edit("s1", "3", "D")},
            CASE WHEN i = 's' AND fault NOT IN (1, 2) THEN {_edit("s0", "cut", "K", "role || ':' || text")} END),
        least({_edit("c2", "3", "D")}, {_take("s0", "u", "user")}, {_take("s1", "u", "user")},
            {_take("c3", "u", "user")}),
        least({_edit("c3", "3", "D")}, {_take("c2", "a", "assistant")})
    FROM (SELECT *, least(s3, {_insert("c2", "assistant")}) AS c3 FROM (
        SELECT w.* EXCLUDE (k), r.* EXCLUDE (conv_id), least(s2, {_insert("s0", "user")},
            {_insert("s1", "user")}, {_insert("s3", "user")}) AS c2
        FROM walk w JOIN coded r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.k = w.k + 1))),
ended AS (
    SELECT conv_id, k, least(s0, s3, {_insert("s2", "assistant")}) AS best,
        row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) AS back
    FROM walk),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
        count(*) FILTER (fault = 3) AS truncated, sum(odd)::BIGINT AS illegal
    FROM judged GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
    sha256(substr(best.t, 2)) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id WHERE back = 1
"""
