"""DuckDB SQL for the rows of queries that SQL can express."""

from __future__ import annotations


def _centroids(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Rounds written out one after the other; every vector is compared with every centroid."""
    out = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS k, v FROM kept QUALIFY k < {k})",
    ]
    for r in range(rounds + 1):
        out.append(
            f"""a{r} AS MATERIALIZED (SELECT rid, vec_id, any_value(kept.v) AS v, min(list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT * {k} + k) AS m
            FROM kept, c{r} c GROUP BY rid, vec_id)"""
        )
        if r < rounds:
            out.append(
                f"""s{r} AS (SELECT m % {k} AS k, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, {dims + 1}) t(i) GROUP BY ALL),
            c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(n.v, c.v) AS v FROM c{r} c LEFT JOIN
            (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM s{r} GROUP BY k) n ON n.k = c.k)"""
            )
    return f"""WITH {", ".join(out)}, done AS (SELECT vec_id, (m % {k})::INTEGER AS cluster, (m // {k})::BIGINT AS distance FROM a{rounds})
    SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
        sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM done JOIN c{rounds} c ON c.k = done.cluster"""


def _tree(name: str, leaves: str, group: str, levels: int) -> list[str]:
    """Tables {name}0 and so on: (group, i, h, n) on each level, n nodes in the group; a single node stays as it is."""
    out = [f"{name}0 AS MATERIALIZED (SELECT {group}, i, h, count(*) OVER (PARTITION BY {group}) AS n FROM {leaves})"]
    for t in range(levels):
        out.append(
            f"""{name}{t + 1} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY {group}) AS n FROM
            (SELECT {group}, i // 2 AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{t} GROUP BY {group}, i // 2))"""
        )
    return out


def _fold(name: str, group: str, place: str, levels: int, into: str) -> list[str]:
    """Steps from a row's node f at `place` to the top of its tree: siblings are appended to p, the digest goes on."""
    out = []
    for t in range(levels):
        out.append(
            f"""{into}{t + 1} AS MATERIALIZED (SELECT r.* REPLACE (r.p || coalesce(s.h, '') AS p,
            CASE WHEN own.n = 1 THEN r.f WHEN s.h IS NULL THEN sha256(r.f) WHEN (r.{place} >> {t}) & 1 = 1 THEN sha256(s.h || r.f) ELSE sha256(r.f || s.h) END AS f)
            FROM {into}{t} r JOIN {name}{t} own ON own.{group} = r.{group} AND own.i = r.{place} >> {t}
            LEFT JOIN {name}{t} s ON s.{group} = r.{group} AND s.i = xor(r.{place} >> {t}, 1))"""
        )
    return out


def _manifest(levels: int = 24, group_levels: int = 8) -> str:
    """Levels written out: enough for 2 ** levels documents of one language and 2 ** group_levels languages."""
    part = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda n: "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", n, "text"))) + ")"
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""
    tables = [
        f"""docs AS MATERIALIZED (SELECT doc_id, lang, coalesce('x' || lang, '') AS g, {leaf("n_chars")} AS leaf,
        CASE WHEN {crc} % 7 = 0 THEN {leaf("(n_chars::HUGEINT + 1)")} ELSE {leaf("n_chars")} END AS claimed FROM documents)""",
        "placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM docs)",
        "leaves AS (SELECT g, place AS i, leaf AS h FROM placed)",
        *_tree("n", "leaves", "g", levels),
        f"tops AS MATERIALIZED (SELECT g, h, 0 AS one, row_number() OVER (ORDER BY g) - 1 AS i FROM n{levels})",
        *_tree("r", "tops", "one", group_levels),
        f"a0 AS (SELECT p.*, t.h AS subroot, t.i AS at, 0 AS one, '' AS p, claimed AS f, (SELECT h FROM r{group_levels}) AS root FROM placed p JOIN tops t ON t.g = p.g)",
        *_fold("n", "g", "place", levels, "a"),
        f"b0 AS (SELECT * FROM a{levels})",
        *_fold("r", "one", "at", group_levels, "b"),
    ]
    return f"""WITH {", ".join(tables)} SELECT doc_id, lang, place, leaf, subroot, root, sha256(p) AS proof_sha256, f AS folded_root, f = root AS verified FROM b{group_levels}"""


CENTROIDS, MANIFEST = _centroids(), _manifest()
