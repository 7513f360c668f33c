"""The vector queries as SQL for DuckDB: the same rounds as chains of tables, every pair compared."""

from __future__ import annotations

from retailpulse.llm import centroids, vector_codes

_SOUND = "len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"
_WHOLE = "list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE)))"
_DISTANCE = "CAST(list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, c.v) + list_dot_product(c.v, c.v) AS BIGINT)"


def _assigned(source: str, centres: str, n: int) -> str:
    """(u, part, m): distance times n plus the number of the nearest centre, so that ties go to the smallest."""
    return f"SELECT x.u, x.part, min({_DISTANCE} * {n} + c.k) AS m FROM {source} x JOIN {centres} c ON x.part = c.part GROUP BY x.u, x.part"


def _moved(source: str, before: str, found: str, n: int) -> str:
    flat = f"SELECT x.part, a.m % {n} AS k, generate_subscripts(x.v, 1) AS pos, unnest(x.v) AS y FROM {source} x JOIN {found} a ON x.u = a.u AND x.part = a.part"
    means = f"SELECT part, k, pos, floor(sum(y) / count(*)) AS y FROM ({flat}) GROUP BY part, k, pos"
    lists = f"SELECT part, k, list(y ORDER BY pos) AS v FROM ({means}) GROUP BY part, k"
    return f"SELECT c.part, c.k, coalesce(s.v, c.v) AS v FROM {before} c LEFT JOIN ({lists}) s ON c.part = s.part AND c.k = s.k"


def _rounds(source: str, n: int, rounds: int) -> list[str]:
    """Tables a1, c1, a2, ... from c0, and the last assignment ``a``."""
    out = []
    for r in range(1, rounds + 1):
        out.append(f"a{r} AS MATERIALIZED ({_assigned(source, f'c{r - 1}', n)})")
        out.append(f"c{r} AS MATERIALIZED ({_moved(source, f'c{r - 1}', f'a{r}', n)})")
    return [*out, f"a AS MATERIALIZED ({_assigned(source, f'c{rounds}', n)})"]


def _text(numbers: str) -> str:
    return f"array_to_string(list_transform({numbers}, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')"


def centroid_sql() -> str:
    n, rounds = centroids.CLUSTERS, centroids.ROUNDS
    order = f"ORDER BY sha256('{centroids.SEED}:' || vec_id), v"
    tables = [
        f"kept AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS u, 0 AS part, {_WHOLE.format(scale=centroids.SCALE)} AS v "
        f"FROM embeddings WHERE len(embedding) = {centroids.DIMS} AND {_SOUND})",
        f"c0 AS MATERIALIZED (SELECT part, row_number() OVER ({order}) - 1 AS k, v FROM kept QUALIFY k < {n})",
        *_rounds("kept", n, rounds),
        f"found AS (SELECT u, CAST(m % {n} AS INTEGER) AS k, m // {n} AS distance FROM a)",
    ]
    return f"""WITH {', '.join(tables)}
SELECT kept.vec_id, f.k AS cluster, f.distance,
  CAST(sum(f.distance) OVER (PARTITION BY f.k) AS BIGINT) AS cluster_inertia, CAST(sum(f.distance) OVER () AS BIGINT) AS inertia,
  sha256({_text('c.v')}) AS centroid_sha256
FROM kept JOIN found f ON kept.u = f.u JOIN c{rounds} c ON c.k = f.k"""


def code_sql() -> str:
    n, parts, rounds = vector_codes.ENTRIES, vector_codes.PARTS, vector_codes.ROUNDS
    code = " || ".join(f"lower(lpad(to_hex(max(m % {n}) FILTER (WHERE part = {p})), 2, '0'))" for p in range(parts))
    tables = [
        f"sound AS MATERIALIZED (SELECT vec_id, label, row_number() OVER () AS u, {_WHOLE.format(scale=vector_codes.SCALE)} AS v "
        f"FROM embeddings WHERE {_SOUND} AND len(embedding) % {parts} = 0)",
        "ranked AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id, v) - 1 AS k FROM sound "
        "WHERE len(v) = (SELECT len(v) FROM sound ORDER BY vec_id, v LIMIT 1))",
        f"cut AS MATERIALIZED (SELECT u, k, part, list_slice(v, part * (len(v) // {parts}) + 1, (part + 1) * (len(v) // {parts})) AS v "
        f"FROM ranked, range({parts}) AS p(part))",
        f"c0 AS MATERIALIZED (SELECT part, k, v FROM cut WHERE k < {n})",
        *_rounds("cut", n, rounds),
        f"rows AS (SELECT u, {code} AS code, CAST(sum(m // {n}) AS BIGINT) AS error FROM a GROUP BY u)",
        f"books AS (SELECT sha256(string_agg({_text('v')}, ',' ORDER BY part, k)) AS codebooks_sha256 FROM c{rounds})",
    ]
    return f"""WITH {', '.join(tables)}
SELECT ranked.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY ranked.label) AS BIGINT) AS label_error, codebooks_sha256
FROM ranked JOIN rows r ON ranked.u = r.u, books"""
