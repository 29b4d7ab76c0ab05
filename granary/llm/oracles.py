"""SQL counterparts of the operators that plain SQL can express."""

from __future__ import annotations

POISSON_MIX = """
WITH RECURSIVE rows_ AS (SELECT *, row_number() OVER () AS r FROM documents),
counted AS (SELECT source, count(*) AS n FROM documents GROUP BY 1),
sums AS (SELECT CAST(sum(n) AS DOUBLE) AS total, count(*) AS sources FROM counted),
means AS (SELECT source, pieces, rate / pieces AS mean FROM (
    SELECT source, rate, CAST(greatest(1, ceil(rate / 16.0)) AS INTEGER) AS pieces
    FROM (SELECT source, total * (1.0 / sources) / n AS rate FROM counted, sums))),
steps AS (
    SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS reached FROM means
    UNION ALL
    SELECT source, mean, k + 1, p * mean / (k + 1), reached + p * mean / (k + 1) FROM steps WHERE k < ceil(mean + 12 * sqrt(mean) + 30)),
dice AS (
    SELECT r, d.source, (CAST('0x' || substr(md5(concat_ws('|', 'mix', coalesce(CAST(doc_id AS VARCHAR), 'null'), md5(coalesce(text, 'null')),
        CAST(piece AS VARCHAR))), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
    FROM rows_ d JOIN means m ON d.source IS NOT DISTINCT FROM m.source, LATERAL (SELECT unnest(range(1, m.pieces + 1)) AS piece)),
copies AS (SELECT r, count(s.k) AS n FROM dice d LEFT JOIN steps s ON d.source IS NOT DISTINCT FROM s.source AND s.reached < d.u GROUP BY r)
SELECT doc_id, text, lang, d.source, n_chars, CAST(unnest(range(0, c.n)) AS INTEGER) AS copy FROM rows_ d JOIN copies c USING (r)
"""

NEAR_COPIES = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
        ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s FROM worded),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b USING (shingle)
    WHERE a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reached(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
least_ AS (SELECT x, min(y) AS y FROM reached GROUP BY x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id,
       doc_id <= coalesce(y, doc_id) AS kept
FROM sets LEFT JOIN least_ ON doc_id = x
"""

FILTER_AUDIT = r"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
least_ AS (SELECT t, min(doc_id) AS first FROM texts GROUP BY t),
worded AS (SELECT doc_id, part, t, first, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts JOIN least_ USING (t)),
marks AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
masked AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(w) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask
    FROM worded LEFT JOIN marks USING (doc_id)),
counted AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masked GROUP BY part, mask),
letters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
paths(o, used) AS (SELECT f, bit FROM letters UNION ALL SELECT o || f, used + bit FROM paths, letters WHERE used & bit = 0),
steps AS (
    SELECT p.o AS filter_order, CAST(s AS INT) AS step, l.bit AS bit,
        (SELECT coalesce(sum(b.bit), 0) FROM letters b WHERE strpos(p.o, b.f) < s) AS earlier
    FROM paths p, range(1, 6) r(s), letters l WHERE length(p.o) = 5 AND l.f = substr(p.o, s, 1)),
applied AS (
    SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & (earlier + bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & earlier <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM counted, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
    CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM applied
"""


def _centroids(rounds: int) -> str:
    """DuckDB SQL: centroids and assignments of as many rounds, by plain sums of squares."""
    ctes = [
        """kept AS (
    SELECT row_number() OVER () AS r, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        """c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS cluster, v
    FROM kept ORDER BY sha256('1:' || vec_id), v LIMIT 16)""",
    ]
    for k in range(rounds + 1):
        ctes.append(f"""far{k} AS (
    SELECT r, cluster, list_sum([(k.v[i] - c.v[i]) * (k.v[i] - c.v[i]) FOR i IN range(1, 65)]) AS distance FROM kept k, c{k} c)""")
        ctes.append(f"""near{k} AS (
    SELECT r, min(cluster) AS cluster, any_value(distance) AS distance FROM far{k} JOIN (SELECT r, min(distance) AS distance FROM far{k} GROUP BY r)
        USING (r, distance) GROUP BY r)""")
        if k < rounds:
            ctes.append(f"""sums{k} AS (
    SELECT cluster, i, sum(v[i]) AS total, count(*) AS n FROM near{k} JOIN kept USING (r), range(1, 65) g(i) GROUP BY cluster, i)""")
            ctes.append(f"""c{k + 1} AS (
    SELECT c.cluster, coalesce(any_value(m.v), any_value(c.v)) AS v FROM c{k} c LEFT JOIN (
        SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM sums{k} GROUP BY cluster) m USING (cluster) GROUP BY c.cluster)""")
    last = rounds
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
    CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM near{last} a JOIN kept USING (r) JOIN c{last} c ON a.cluster = c.cluster
"""


TABLE_CLUSTERS = _centroids(3)


NGRAM_JOIN = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM worded),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b USING (shingle)
    WHERE a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reached(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
least_ AS (SELECT x, min(y) AS y FROM reached GROUP BY x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id
FROM sets LEFT JOIN least_ ON doc_id = x
"""

ORACLES: dict[str, str] = {
    "op3_hyperminhash": NEAR_COPIES, "op8_poisson_mix": POISSON_MIX, "op11_table_clusters": TABLE_CLUSTERS, "op12_ngram_join": NGRAM_JOIN,
    "op13_filter_audit": FILTER_AUDIT,
}
