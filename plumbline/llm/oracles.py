"""The SQL that line removal, clustering and the manifest must agree with. Steps that repeat are written out by a loop."""

from __future__ import annotations

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINES = rf"""
    WITH l AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nth
        FROM documents
    ), k AS (
        SELECT *, translate(trim(line, {BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
    ), r AS (
        SELECT key, min(doc_id) AS least FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
    ), j AS (
        SELECT k.*, least IS NOT NULL AND doc_id > least AS dropped FROM k LEFT JOIN r USING (key)
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT dropped), '')) AS kept_sha256
    FROM j GROUP BY doc_id
"""


def manifest(levels: int = 8, groups: int = 3) -> str:
    """Trees of up to 8 ** ``levels`` leaves in up to 8 ** ``groups`` groups."""
    value = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value.format(f"({c})") for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    tampered = "CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"

    def tree(name: str, depth: int) -> list[str]:
        """From ``name``_0 (g, i, d) upwards: nodes with what stands left and right of each, nothing in a group of one node."""
        out = []
        for k in range(depth):
            here = f"PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN"
            out.append(f"""{name}s_{k} AS (
                SELECT g, i, d, count(*) OVER (PARTITION BY g) = 1 AS lone,
                       CASE WHEN lone THEN '' ELSE coalesce(string_agg(d, '') OVER ({here} UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
                       CASE WHEN lone THEN '' ELSE coalesce(string_agg(d, '') OVER ({here} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r
                FROM {name}_{k})""")
            out.append(f"""{name}_{k + 1} AS (
                SELECT g, i // 8 AS i, CASE WHEN any_value(lone) THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
                FROM {name}s_{k} GROUP BY g, i // 8)""")
        return out

    # CRC-32 bit by bit, over the bytes of the decimal id.
    step = "list_reduce(range(9), lambda c, b: CASE WHEN b = 0 THEN c WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, {0})"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, x: {step.format('xor(c, x)')}), 4294967295)"
    parts = [
        f"c AS (SELECT *, {crc} AS crc FROM documents)",
        f"e AS (SELECT doc_id, lang AS g, {leaf('text')} AS d, {leaf(tampered)} AS t FROM c)",
        "n AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, d) - 1 AS i FROM e)",
        "a_0 AS (SELECT g, i, d FROM n)",
        *tree("a", levels),
        f"b_0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, d FROM a_{levels})",
        f"names AS (SELECT g AS name, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS j, d AS subroot FROM a_{levels})",
        *tree("b", groups),
        f"f_0 AS (SELECT n.*, subroot, j, (SELECT d FROM b_{groups}) AS root, '' AS p, t AS f FROM n JOIN names ON n.g IS NOT DISTINCT FROM name)",
    ]
    at = 0
    for name, depth, on in (("a", levels, "s.g IS NOT DISTINCT FROM f.g AND s.i = f.i // {0}"), ("b", groups, "s.i = f.j // {0}")):
        for k in range(depth):
            parts.append(f"""f_{at + 1} AS (
                SELECT f.* REPLACE (p || l || r AS p, CASE WHEN lone THEN f ELSE sha256(l || f || r) END AS f)
                FROM f_{at} f JOIN {name}s_{k} s ON {on.format(8**k)})""")
            at += 1
    return f"WITH {', '.join(parts)} SELECT doc_id, d AS leaf, subroot, root, sha256(p) AS proof_sha256, f AS folded_root, f = root AS verified FROM f_{at}"


def clusters(k: int = 40, rounds: int = 5) -> str:
    distance = "list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    floor = "(s - ((s % n) + n) % n) // n"
    parts = [
        """kept AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c_0 AS (
            SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, v AS m
            FROM (SELECT v, sha256('2:' || vec_id::VARCHAR) AS h FROM kept ORDER BY h LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a_{i} AS MATERIALIZED (
            SELECT vec_id, v, cluster, distance FROM (
                SELECT vec_id, v, cluster, {distance} AS distance, row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS best FROM kept, c_{i})
            WHERE best = 1)""")
        if i < rounds:
            parts.append(f"""s_{i} AS (
                SELECT cluster, list({floor} ORDER BY nth) AS moved FROM (
                    SELECT cluster, nth, sum(x)::BIGINT AS s, count(*) AS n
                    FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS nth FROM a_{i}) GROUP BY cluster, nth)
                GROUP BY cluster)""")
            parts.append(f"c_{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(moved, m) AS m FROM c_{i} LEFT JOIN s_{i} USING (cluster))")
    return f"""
        WITH {", ".join(parts)}
        SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
               sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM a_{rounds} JOIN c_{rounds} USING (cluster)
    """


ORACLES: dict[str, str] = {
    "op11_line_dedup": LINES,
    "op12_hilbert_centroids": clusters(),
    "op13_merkle_manifest": manifest(),
}
