"""SQL of the centroid and manifest queries, for DuckDB."""

from __future__ import annotations


def clusters_sql(k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256) -> str:
    """Every round as two steps: assign all vectors, then move the centroids."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
    SELECT n, any_value(q) AS q, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
    FROM (SELECT v.n, v.q, c.cluster, CAST(list_sum(list_transform(range(1, {size + 1}), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i]))) AS BIGINT) AS d FROM v CROSS JOIN c{r} c)
    GROUP BY n
)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
    SELECT c.cluster, coalesce(m.q, c.q) AS q
    FROM c{r} c LEFT JOIN (
        SELECT cluster, list(part ORDER BY i) AS q
        FROM (SELECT cluster, i, CAST(floor_div(sum(x), count(*)) AS BIGINT) AS part FROM (SELECT cluster, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM a{r}) GROUP BY cluster, i)
        GROUP BY cluster
    ) m ON m.cluster = c.cluster
)""")
    chain = ",".join(steps).replace("floor_div(sum(x), count(*))", "(CAST(sum(x) AS BIGINT) - ((CAST(sum(x) AS BIGINT) % count(*)) + count(*)) % count(*)) // count(*)")
    return f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), q) - 1 AS INTEGER) AS cluster, q
    FROM v QUALIFY cluster < {k}
),{chain},
sums AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY cluster)
SELECT v.vec_id, a.cluster, a.distance, s.cluster_inertia,
       (SELECT CAST(sum(distance) AS BIGINT) FROM a{rounds}) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v ON v.n = a.n JOIN sums s ON s.cluster = a.cluster JOIN c{rounds} c ON c.cluster = a.cluster
"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: CRC-32 bit by bit: each character opens eight steps.
_CRC = """xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
        lambda crc, byte: xor(xor(crc, byte) >> 1, (xor(crc, byte) & 1) * 3988292384)
    ), 4294967295)"""


def manifest_sql() -> str:
    """Levels of the trees by recursion, then every leaf's way up."""

    def tree(name: str, start: str) -> str:
        return f"""
{name} AS (
    SELECT grp, 0 AS level, idx, hash, count(*) OVER (PARTITION BY grp) AS width FROM ({start})
    UNION ALL
    SELECT grp, level + 1, idx // 2, sha256(hash || coalesce(next, '')), (width + 1) // 2
    FROM (SELECT *, lead(hash) OVER (PARTITION BY grp ORDER BY idx) AS next FROM {name} WHERE width > 1)
    WHERE idx % 2 = 0
)"""

    def siblings(own: str) -> str:
        return f"CASE WHEN {own} % 2 = 0 THEN {own} + 1 ELSE {own} - 1 END"

    return f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT row_number() OVER () AS n, doc_id, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS grp, {_leaf("n_chars")} AS leaf,
           CASE WHEN n_chars IS NOT NULL AND {_CRC} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS changed
    FROM documents
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, n) - 1 AS idx FROM leaves
),{tree("low", "SELECT grp, idx, leaf AS hash FROM placed")},
subroots AS MATERIALIZED (
    SELECT grp, hash AS subroot, level AS height, row_number() OVER (ORDER BY grp) - 1 AS place FROM low WHERE width = 1
),{tree("high", "SELECT '' AS grp, place AS idx, subroot AS hash FROM subroots")},
top AS (SELECT hash AS root, level AS height FROM high WHERE width = 1),
steps AS MATERIALIZED (
    SELECT p.n, l.level, s.hash AS sibling, (p.idx >> l.level) % 2 AS side
    FROM placed p JOIN subroots r ON r.grp = p.grp JOIN (SELECT DISTINCT grp, level FROM low) l ON l.grp = p.grp AND l.level < r.height
    LEFT JOIN low s ON s.grp = p.grp AND s.level = l.level AND s.idx = {siblings("(p.idx >> l.level)")}
    UNION ALL
    SELECT p.n, 1000 + l.level, s.hash, (r.place >> l.level) % 2
    FROM placed p JOIN subroots r ON r.grp = p.grp JOIN (SELECT DISTINCT level FROM high) l ON l.level < (SELECT height FROM top)
    LEFT JOIN high s ON s.level = l.level AND s.idx = {siblings("(r.place >> l.level)")}
), proofs AS (
    SELECT n, string_agg(sibling, '' ORDER BY level) AS proof, list({{'sibling': coalesce(sibling, ''), 'side': side}} ORDER BY level) AS path
    FROM steps GROUP BY n
), folds AS (
    SELECT n, 0 AS done, coalesce(changed, leaf) AS node, path FROM placed LEFT JOIN proofs USING (n)
    UNION ALL
    SELECT n, done + 1, sha256(CASE WHEN path[done + 1].side = 0 THEN node || path[done + 1].sibling ELSE path[done + 1].sibling || node END), path
    FROM folds WHERE done < coalesce(len(path), 0)
)
SELECT p.doc_id, p.leaf, r.subroot, top.root, sha256(coalesce(f.proof, '')) AS proof_sha256, g.node AS folded_root, g.node = top.root AS verified
FROM placed p JOIN subroots r ON r.grp = p.grp CROSS JOIN top LEFT JOIN proofs f ON f.n = p.n
JOIN folds g ON g.n = p.n AND g.done = coalesce(len(g.path), 0)
"""
