"""DuckDB statements of the operators that SQL can express, by plainer means than the operators'."""

from __future__ import annotations

from barloom.llm import sharding, urls

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _reachable(ids: str, links: str) -> str:
    """CTEs ``reach`` and ``smallest`` (id, component_id) over the symmetric link table."""
    return f"""reach AS (
  SELECT id AS a, id AS b FROM {ids}
  UNION SELECT reach.a, {links}.b FROM reach JOIN {links} ON {links}.a = reach.b),
smallest AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""


# All pairs that share a shingle, counted; then reachability over the links.
OP1_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                          '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i:i+2]) END) AS s
  FROM words),
ids AS (SELECT id, dense_rank() OVER (ORDER BY s) AS s FROM sets),
sizes AS (SELECT id, count(*) AS n FROM ids GROUP BY id),
common AS (
  SELECT a.id AS a, b.id AS b, count(*) AS c
  FROM ids a JOIN ids b ON a.s = b.s AND a.id <> b.id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
{_reachable("words", "links")}
SELECT words.id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, words.id = component_id AS kept
FROM words LEFT JOIN sizes USING (id) JOIN smallest USING (id)
"""


def op2_sql(shards: list[str]) -> str:
    listed = ",".join(map(str, sharding.lookup_table(shards)))
    return f"""
WITH filled AS (
  SELECT unnest(range({sharding.SLOTS})) AS slot,
         unnest(string_split('{listed}', ',')) AS number),
placed AS (
  SELECT doc_id, ('0x' || left(md5(coalesce(doc_id::VARCHAR, '')), 15))::BIGINT % {sharding.SLOTS}
    AS slot FROM documents)
SELECT doc_id, slot::INTEGER AS slot, 'shard-' || lpad(number, 3, '0') AS shard
FROM placed JOIN filled USING (slot)
"""


# Every window against every run of as many document words.
OP3_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, len(win) AS l, win FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 11, 2)),
                                          lambda i: w[i:i+12])) AS win
    FROM b WHERE len(w) > 0)),
runs AS (
  SELECT doc_id, l, i, array_to_string(w[i:i+l-1], ' ') AS run FROM (
    SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i
    FROM d, (SELECT DISTINCT l FROM windows))),
found AS (
  SELECT DISTINCT doc_id, item_id, i, l FROM runs
  JOIN (SELECT item_id, array_to_string(win, ' ') AS run FROM windows) USING (run)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP8_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e FROM embeddings),
usable AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT p.id AS a, q.id AS b FROM usable p JOIN usable q
  ON p.label = q.label AND p.id <> q.id AND len(p.e) = len(q.e)
  WHERE list_cosine_similarity(p.e, q.e) >= 0.93),
{_reachable("v", "links")}
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
FROM v LEFT JOIN (SELECT a AS id, count(*) AS n FROM links GROUP BY a) USING (id)
JOIN smallest USING (id)
"""


def _op10_rounds() -> str:
    """One CTE per step of the flow."""
    out = "score0 AS (SELECT kind, host, seed, seed AS score FROM seeds)"
    for k in range(urls.ROUNDS):
        out += f""",
score{k + 1} AS (
  SELECT s.kind, s.host, s.seed, s.seed + {urls.DAMPING} * coalesce(g.got, 0) AS score
  FROM score{k} s LEFT JOIN (
    SELECT f.kind, f.dst AS host, sum(f.share * p.score) AS got
    FROM flows f JOIN score{k} p ON p.kind = f.kind AND p.host = f.src GROUP BY 1, 2) g
  ON g.kind = s.kind AND g.host = s.host)"""
    return out


OP10_SQL = rf"""
WITH rules(rule, verdict) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'),
                                     ('example.com/de/', 'block'), ('org/fr/', 'allow')),
p AS (
  SELECT page_id, html,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
              '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
ruled AS (
  SELECT p.*, rule, verdict FROM p LEFT JOIN LATERAL (
    SELECT rule, verdict FROM rules
    WHERE (p.host = split_part(rule, '/', 1) OR ends_with(p.host, '.' || split_part(rule, '/', 1)))
      AND starts_with(p.path, substr(rule, strpos(rule, '/')))
    ORDER BY length(rule) DESC LIMIT 1) ON true),
shares AS (
  SELECT host, avg(CASE WHEN verdict = 'allow' THEN 1.0 ELSE 0.0 END) AS trust,
         avg(CASE WHEN verdict = 'block' THEN 1.0 ELSE 0.0 END) AS distrust
  FROM ruled GROUP BY host),
linked AS (
  SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''),
    '<a\s[^>]*?href\s*=\s*["'']?\s*([^"''\s>]+)', 1, 'si')) AS link FROM p),
edges AS (
  SELECT src, dst, count(*) AS links FROM (
    SELECT src, translate(regexp_extract(link, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1),
                          '{UPPER}', '{LOWER}') AS dst FROM linked)
  WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY 1, 2),
directed AS (
  SELECT 'trust' AS kind, src, dst, links FROM edges
  UNION ALL SELECT 'distrust', dst, src, links FROM edges),
flows AS (
  SELECT kind, src, dst, links / sum(links) OVER (PARTITION BY kind, src) AS share FROM directed),
seeds AS (
  SELECT kind, host, sum(seed) AS seed FROM (
    SELECT 'trust' AS kind, host, trust AS seed FROM shares
    UNION ALL SELECT 'distrust', host, distrust FROM shares
    UNION ALL SELECT kind, dst, 0 FROM flows) GROUP BY 1, 2),
{_op10_rounds()},
scores AS (
  SELECT host, sum(score) FILTER (kind = 'trust') AS trust,
         sum(score) FILTER (kind = 'distrust') AS distrust
  FROM score{urls.ROUNDS} GROUP BY host)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN host <> '' AND round(distrust - trust, 9) >= {urls.THRESHOLD}
                              THEN 'block' ELSE 'allow' END) AS verdict,
       round(trust, 9) AS trust, round(distrust, 9) AS distrust
FROM ruled JOIN scores USING (host)
"""

# Every anchor against every row.
OP11_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         list_inner_product(a.e, r.e)::BIGINT AS score
  FROM r a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id))::INTEGER AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""

# Every string of 100 bytes as text of 200 hex digits.
OP12_SQL = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM b WHERE len(h) >= 200)),
later AS (
  SELECT doc_id, i FROM strings
  QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
opened AS (
  SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 100, true) AS opens
  FROM later),
spans AS (
  SELECT doc_id, min(i) AS start, max(i) + 100 AS stop
  FROM (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM opened)
  GROUP BY doc_id, k),
pieces AS (
  SELECT doc_id, start, stop, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS since
  FROM (SELECT doc_id, start, stop FROM spans
        UNION ALL SELECT doc_id, len(h) // 2, NULL FROM b)),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (start - since)), '' ORDER BY start) AS h,
         coalesce(sum(stop - start), 0)::BIGINT AS n_removed, count(stop) AS n_spans
  FROM pieces JOIN b USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(b.h) // 2 AS n_bytes, n_removed, n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM b JOIN kept USING (doc_id)
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in (
        "doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"


def _tree(name: str, base: str) -> str:
    """CTEs ``name`` (level, tree, pos, node) over ``base``, its siblings and its height."""
    return f"""
{name} AS (
  SELECT 0 AS level, tree, pos, node FROM {base}
  UNION ALL
  SELECT level + 1, tree, pos // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM {name}
  WHERE tree IN (SELECT tree FROM {name} GROUP BY tree HAVING count(*) > 1)
  GROUP BY level, tree, pos // 3),
{name}_beside AS (
  SELECT level, tree, pos,
         coalesce(string_agg(node, '') OVER (PARTITION BY level, tree, pos // 3 ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(node, '') OVER (PARTITION BY level, tree, pos // 3 ORDER BY pos
                  ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}),
{name}_top AS (
  SELECT tree, max(level) AS height, arg_max(node, level) AS node FROM {name} GROUP BY tree)"""


def _fold(name: str, tree: str, base: str) -> str:
    return f"""
{name} AS (
  SELECT id, tree, pos, 0 AS level, value, proof FROM {base}
  UNION ALL
  SELECT f.id, f.tree, f.pos // 3, f.level + 1, sha256(s.l || f.value || s.r), f.proof || s.l || s.r
  FROM {name} f JOIN {tree}_beside s ON s.tree = f.tree AND s.level = f.level AND s.pos = f.pos
  JOIN {tree}_top t ON t.tree = f.tree AND f.level < t.height)"""


# The parity of a CRC-32 is that of its lowest bit; eight shifts take in one byte.
_CRC = """list_reduce(list_prepend(4294967295, flatten(list_transform(
    range(1, length(doc_id::VARCHAR) + 1),
    lambda k: [ascii(substr(doc_id::VARCHAR, k, 1)), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384)
               ELSE c >> 1 END)"""

OP13_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('g' || source, '') AS tree,
         {_leaf("text")} AS leaf,
         CASE WHEN xor({_CRC}, 4294967295) & 1 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS other
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
{_tree("low", "(SELECT tree, pos, leaf AS node FROM placed)")},
crowned AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, node, tree AS name
            FROM low_top),
{_tree("high", "crowned")},
{_fold("up", "low", "(SELECT id, tree, pos, coalesce(other, leaf) AS value, '' AS proof FROM placed)")},
risen AS (
  SELECT up.id, c.tree, c.pos, up.value, up.proof FROM up
  JOIN low_top t ON t.tree = up.tree AND t.height = up.level JOIN crowned c ON c.name = up.tree),
{_fold("last", "high", "risen")}
SELECT d.doc_id, d.leaf, low_top.node AS subroot, high_top.node AS root,
       sha256(last.proof) AS proof_sha256, last.value AS folded_root,
       last.value = high_top.node AS verified
FROM last JOIN high_top ON last.level = high_top.height JOIN d USING (id)
JOIN low_top ON low_top.tree = d.tree
"""
