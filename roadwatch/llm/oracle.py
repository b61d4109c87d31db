"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

#: Words are maximal runs of anything but space and U+0009..U+000D.
WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

OP8_MIXING = f"""
WITH d AS (SELECT doc_id, source, text, {WORDS}::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS cap,
             [3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::BIGINT AS w FROM s),
f AS (SELECT *, (SELECT sum(source_size) FROM s)::DOUBLE * 1.5::DOUBLE
                  - coalesce(sum(cap) OVER o, 0)::DOUBLE AS rest,
             ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER o, 0))::DOUBLE AS wrest,
             cap::DOUBLE / w AS r
      FROM w WINDOW o AS (ORDER BY cap::DOUBLE / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lvl AS (SELECT arg_min(rest, r) AS l, arg_min(wrest, r) AS wl, min(r) AS r0 FROM f WHERE cap * wrest > rest * w),
t AS (SELECT source, source_size, CASE WHEN r0 IS NOT NULL AND r >= r0 THEN w * l / wl ELSE cap::DOUBLE END AS target FROM f, lvl),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target)::BIGINT // t.source_size ELSE 0 END AS passes,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size, d.text
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (passes * size + greatest(0, least(size, floor(target)::BIGINT - passes * source_size - ahead)))::BIGINT AS taken
FROM p
"""

# Matches and the pieces between them give the spans: a match starts after all
# pieces up to it and all matches before it.
_ASSIGN = ("""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
           """|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""")


def _found(kind: str, number: int, pattern: str, group: int, least: int) -> str:
    return f"""
    SELECT doc_id, row_id, {number} AS k, '{kind}' AS kind,
           (list_sum(list_transform(p[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0))::BIGINT AS b,
           length(m[i]) AS n
    FROM (SELECT doc_id, row_id, unnest(range(1, len(m) + 1)) AS i, m, g, string_split_regex(t, '{pattern}') AS p
          FROM (SELECT *, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS g FROM d) WHERE len(m) > 0)
    WHERE length(g[i]) >= {least}"""


_BASE = (("assign", _ASSIGN, 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]{32,}", 0, 32))


def _op1_secret_scan() -> str:
    """The base kinds are written out above; the published key forms are the rules' own
    expressions, which RE2 reads alike."""
    from roadwatch.llm.secret_scan import KEY_RULES
    kinds = [*_BASE, *((r.kind, r.pattern, r.group, r.least) for r in KEY_RULES)]
    found = " UNION ALL ".join(_found(kind, k, pattern, group, least) for k, (kind, pattern, group, least) in enumerate(kinds))
    joined = "string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, k)"
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS t FROM documents),
f AS ({found}),
a AS (SELECT row_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
             {joined} FILTER (k < {len(_BASE)}) AS base, {joined} AS spans FROM f GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (row_id)
"""


OP11_HARD_NEGATIVES = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, a.label = b.label AS same, b.vec_id AS b, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM e a JOIN e b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT a, b AS positive, score AS ps FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (SELECT p.*, s.b AS negative, s.score AS ns, row_number() OVER (PARTITION BY p.a, positive ORDER BY score DESC, b) AS k
      FROM p JOIN s ON p.a = s.a AND NOT same AND 50 * ps <= 100 * score AND 100 * score <= 95 * ps)
SELECT a AS anchor_id, positive AS positive_id, k::INTEGER AS rank, negative AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE k <= 3
"""

# Every window written out; the operator itself extends anchors only.
OP13_SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x, len(w) AS n FROM d),
g AS (SELECT *, CASE WHEN i + 12 <= n THEN sha256(string_agg(x, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)) END AS s
      FROM p),
m AS (SELECT s, min(doc_id) AS lo FROM g WHERE s IS NOT NULL AND doc_id IS NOT NULL GROUP BY s),
f AS (SELECT g.r, g.i, g.x, coalesce(max(CASE WHEN g.doc_id > m.lo THEN 1 ELSE 0 END)
             OVER (PARTITION BY g.r ORDER BY g.i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), 0) AS gone
      FROM g LEFT JOIN m USING (s)),
k AS (SELECT r, sum(gone)::BIGINT AS n_removed, coalesce(string_agg(x, ' ' ORDER BY i) FILTER (gone = 0), '') AS kept FROM f GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

SQL = {"op1_secret_scan": _op1_secret_scan(), "op8_mixing": OP8_MIXING, "op11_hard_negatives": OP11_HARD_NEGATIVES,
       "op13_substring_dedup": OP13_SUBSTRING_DEDUP}


def _op10_sharding() -> str:
    """The lookup table is filled from the shard names alone and written out here; SQL
    hashes the ids and looks them up."""
    from roadwatch.llm.queries import SHARDS
    from roadwatch.llm.sharding import SLOTS, fill
    names = ", ".join(f"'{s}'" for s in SHARDS)
    return f"""
WITH t AS (SELECT string_split('{",".join(map(str, fill(SHARDS)))}', ',') AS slots, [{names}] AS names),
d AS (SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS})::INTEGER AS slot FROM documents)
SELECT doc_id, slot, names[slots[slot + 1]::INTEGER + 1] AS shard FROM d, t
"""


SQL["op10_sharding"] = _op10_sharding()
