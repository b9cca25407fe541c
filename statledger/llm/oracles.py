"""The registered queries in SQL, where SQL can express them.

Learned and latent operators (3, 6, 7), byte-pair merges (1), learned spans (9) and chains of licence matches (11) have none; their tests use brute force, the original
library or held-out accuracy.
"""

from __future__ import annotations

from . import codes, divergence, urls

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAREST = """
WITH v AS (SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM u q JOIN u c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
b AS (SELECT query_id, vec_id, max(score) AS score FROM s GROUP BY query_id, vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM b)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

CHATS = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS n, list({'role': role, 'text': text} ORDER BY turn NULLS LAST, role, text) AS l FROM t GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, n, l, count(*) AS n_copies FROM c GROUP BY n, l),
k AS (SELECT * FROM u a WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.n > a.n AND b.l[1] = a.l[1] AND list_slice(b.l, 1, a.n) = a.l))
SELECT conv_id, n AS n_turns, n_copies, array_to_string(list_transform(l, lambda x: '<|im_start|>'
  || replace(replace(x.role, '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>') || chr(10)
  || replace(replace(x.text, '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>') || '<|im_end|>' || chr(10)), '') AS chat
FROM k
"""


def _terms(terms) -> str:
    found = ", ".join(f"'{t}'" for t in terms)
    return (f"CAST(len(list_filter([{found}], lambda t: regexp_matches(lower(url_decode(url)), '(^|[^a-z0-9])' || t || '($|[^a-z0-9])'))) AS INTEGER)")


def _rules(value: str) -> str:
    longest = sorted(urls.RULES, key=lambda r: -len(r[0] + r[1]))
    cases = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p if value == 'rule' else v}'" for h, p, v in longest]
    return f"CASE {' '.join(cases)} END"


URLS = f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, {_LOWER.format("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')")} AS host,
  regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
c AS (SELECT *, {_rules("rule")} AS rule, {_rules("verdict")} AS says, {_terms(urls.STRICT)} AS n_strict, {_terms(urls.SOFT)} AS n_soft FROM p)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN n_strict > 0 OR n_soft >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
  n_strict, n_soft FROM c
"""

JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS l FROM documents),
i AS (SELECT doc_id, l, unnest(range(1, greatest(len(l) - 4, 1) + 1)) AS k FROM w WHERE len(l) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(l, k, k + 4), ' ') AS g FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, x.b FROM reach r JOIN both_ways x ON r.b = x.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(least.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.a = d.doc_id
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT *, strlen(h) AS bytes, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN bytes >= 1000 AND page_id < last THEN last END AS refers_to FROM g
"""


def _codes() -> str:
    """Four rounds of assignments and means. Distances are whole numbers, exact as doubles."""
    distance = "list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, b.v) + list_inner_product(b.v, b.v)"
    out = f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor({codes.UNITS} * x)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT CAST(ceil(max(len(v)) / {codes.PARTS}) AS BIGINT) AS w FROM e),
p AS MATERIALIZED (SELECT r, part, list_slice(list_resize(v, w * {codes.PARTS}, 0), part * w + 1, part * w + w) AS v
  FROM e, w, unnest(range({codes.PARTS})) u(part)),
b0 AS MATERIALIZED (SELECT part, i, v FROM p JOIN (SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS i FROM e) USING (r) WHERE i < {codes.ENTRIES}),"""
    for k in range(codes.ROUNDS + 1):
        out += f"""
a{k} AS MATERIALIZED (SELECT r, part, p.v, min(({distance}, i)) AS best FROM p JOIN b{k} b USING (part) GROUP BY r, part, p.v),"""
        if k < codes.ROUNDS:
            out += f"""
m{k} AS (SELECT part, best[2] AS i, x, floor(sum(v[x]) / count(*)) AS m FROM a{k}, unnest(range(1, len(v) + 1)) u(x) GROUP BY ALL),
b{k + 1} AS MATERIALIZED (SELECT part, i, coalesce(n.v, b.v) AS v
  FROM b{k} b LEFT JOIN (SELECT part, i, list(m ORDER BY x) AS v FROM m{k} GROUP BY part, i) n USING (part, i)),"""
    return out + f"""
c AS (SELECT r, string_agg(lower(printf('%02x', best[2])), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a{codes.ROUNDS} GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY part, i)) AS h FROM b{codes.ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM e JOIN c USING (r), h
"""


CODES = _codes()


def _rate(n: str, total: str) -> str:
    return f"1 + (CAST({divergence.SCALE} AS HUGEINT) * ({n} + {divergence.SMOOTH})) // ({total} + {divergence.SMOOTH} * v)"


DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS MATERIALIZED (SELECT r, lang, source, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {divergence.LEAST_DOCUMENTS}),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(DISTINCT term) AS v, sum(n) AS total FROM c GROUP BY lang),
g AS (SELECT DISTINCT lang, source, coalesce(total, 0) AS total FROM d LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
f AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {_rate("coalesce(n, 0)", "g.total")} AS p
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT lang, term, {_rate("sum(n)", "any_value(l.total)").replace("* v", "* any_value(v)")} AS q FROM c JOIN l USING (lang) GROUP BY lang, term),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM f a JOIN f b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM f JOIN q USING (lang, term) WHERE n > 0 AND p > q),
s AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM o)
SELECT * FROM s WHERE part = 'pair' OR rank <= {divergence.TOP}
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_nearest_vectors": NEAREST, "op4_maximal_chats": CHATS, "op5_url_verdicts": URLS, "op8_ngram_jaccard_join": JACCARD,
        "op10_warc_round_trip": WARC, "op12_vector_codes": CODES, "op13_source_divergence": DIVERGENCE,
    }
