"""The text operators' queries in SQL, where SQL can express them."""

from __future__ import annotations

from itertools import permutations
from string import ascii_lowercase, ascii_uppercase


def _words(text: str, between: str) -> str:
    """Words of a text with A-Z lower-cased."""
    return f"list_filter(regexp_split_to_array(translate(coalesce({text}, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '{between}'), lambda w: w <> '')"


_ITEM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK = r"[\x20\x09-\x0D]+"

SUFFIX_DEDUP = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS m FROM k GROUP BY s),
g AS (SELECT doc_id, i FROM k JOIN f USING (s) WHERE m < doc_id),
q AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true)::INT AS fresh FROM g),
t AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM q),
sp AS (SELECT doc_id, r, min(i) AS a, max(i) + 50 AS z FROM t GROUP BY doc_id, r),
v AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS pz FROM sp),
o AS (SELECT v.doc_id, count(*) AS n, sum(z - a) AS gone,
      string_agg(substr(h, 2 * pz + 1, 2 * (a - pz)), '' ORDER BY a) || substr(any_value(h), 2 * max(z) + 1) AS rest
      FROM v JOIN d USING (doc_id) GROUP BY v.doc_id)
SELECT d.doc_id, len(h) // 2 AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0) AS n_spans,
sha256(unhex(coalesce(rest, h))) AS kept_sha256 FROM d LEFT JOIN o USING (doc_id)"""

HAMMING_SEARCH = """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS b FROM embeddings),
p AS (SELECT q.vec_id AS query_id, e.vec_id, list_sum(list_transform(range(1, 65), lambda i: (q.b[i] <> e.b[i])::INT))::INT AS distance
      FROM e q, e WHERE q.vec_id % 20 = 0 AND q.vec_id <> e.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10"""

PARITY_JOIN = f"""WITH RECURSIVE d AS (SELECT doc_id, {_words('text', _BLANK)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT doc_id AS id, doc_id AS low FROM d UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, m.low AS component_id FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT id, min(low) AS low FROM r GROUP BY id) m ON m.id = d.doc_id"""

DECONTAMINATE = f"""WITH d AS (SELECT doc_id, {_words('text', _ITEM)} AS w FROM documents),
b AS (SELECT item_id, {_words('text', _ITEM)} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS k
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
p AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
h AS (SELECT doc_id, i, p.n, item_id FROM p JOIN win ON p.k = win.k AND p.n = win.n),
c AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Rounds of assignment and means, one common table expression each."""
    assign = """a{k} AS MATERIALIZED (SELECT vec_id, p, x, arg_min({{'e': e, 'd': d}}, (d, e)) AS m FROM (SELECT vec_id, v.p, x, e,
list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v JOIN b{k} ON b{k}.p = v.p) GROUP BY ALL)"""
    means = """s{k} AS (SELECT p, m.e AS e, i, sum(unnest_x)::BIGINT AS s, count(*) AS n FROM (SELECT p, m, unnest(x) AS unnest_x, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY ALL),
f{k} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{k} GROUP BY p, e),
b{j} AS MATERIALIZED (SELECT b.p, b.e, coalesce(f.c, b.c) AS c FROM b{k} b LEFT JOIN f{k} f ON f.p = b.p AND f.e = b.e)"""
    steps = ",\n".join(f"{assign.format(k=k)},\n{means.format(k=k, j=k + 1)}" for k in range(rounds))
    return f"""WITH r AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS w FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT vec_id, p, list_slice(w, p * len(w) // {parts} + 1, (p + 1) * len(w) // {parts}) AS x FROM r, (SELECT unnest(range({parts})) AS p)),
b0 AS MATERIALIZED (SELECT p, (row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1)::BIGINT AS e, x AS c FROM v
WHERE vec_id IN (SELECT vec_id FROM r ORDER BY vec_id LIMIT {entries})),
{steps},
{assign.format(k=rounds)},
o AS (SELECT vec_id, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM o JOIN r USING (vec_id), h"""


def _filter_audit(filters: str = "ABCDE") -> str:
    """Masks per part, and every order and step with the bits of its filter and of those before."""
    orders = ", ".join(f"('{''.join(order)}', {k + 1}, {1 << filters.index(f)}, {sum(1 << filters.index(x) for x in order[:k])})"
                       for order in permutations(filters) for k, f in enumerate(order))
    return f"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{_BLANK}'), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY t) AS low FROM d),
k AS (SELECT doc_id, part, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
+ 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * len(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > low, false)::INT AS m FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
g AS (SELECT part, m, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM k LEFT JOIN l USING (doc_id) GROUP BY part, m),
o(filter_order, step, f, e) AS (VALUES {orders}),
s AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (m & (e | f) = 0), 0)::BIGINT AS kept,
coalesce(sum(n) FILTER (m & e = 0 AND m & f <> 0), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (m & e <> 0 AND m & f <> 0), 0)::BIGINT AS redundant,
coalesce(sum(n) FILTER (m = f), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (m & e = 0 AND m & f <> 0), 0)::BIGINT AS good_lost,
coalesce(sum(toxic) FILTER (m & e = 0 AND m & f <> 0), 0)::BIGINT AS toxic_lost FROM g, o GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
(sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM s"""


VECTOR_CODES, FILTER_AUDIT = _vector_codes(), _filter_audit()
