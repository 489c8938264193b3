"""DuckDB SQL of the operators that SQL can express, by plain methods."""

from __future__ import annotations

_FLOOR = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"  # of s / n, whatever the sign
_INTEGERS = "[CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]"
_FINITE = "embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"


def _apart(a: str, b: str) -> str:
    """Squared distance of two integer vectors; sums of products below 2**53 are exact."""
    a, b = f"CAST({a} AS DOUBLE[])", f"CAST({b} AS DOUBLE[])"
    return f"CAST(list_inner_product({a}, {a}) - 2 * list_inner_product({a}, {b}) + list_inner_product({b}, {b}) AS BIGINT)"


def centroids(k: int = 40, rounds: int = 5, dims: int = 64, seed: str = "2") -> str:
    order = f"sha256('{seed}:' || vec_id)"
    steps = [
        f"kept AS MATERIALIZED (SELECT vec_id, {_INTEGERS} AS v FROM embeddings WHERE len(embedding) = {dims} AND {_FINITE})",
        f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS c, v
            FROM (SELECT * FROM kept ORDER BY {order} LIMIT {k}))""",
    ]
    for r in range(rounds + 1):
        near = f"SELECT vec_id, kept.v AS v, min({_apart('kept.v', f'c{r}.v')} * {k} + c) AS best FROM kept, c{r} GROUP BY ALL"
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, v, best // {k} AS d, CAST(best % {k} AS INTEGER) AS c FROM ({near}))")
        if r < rounds:
            steps.append(
                f"""m{r} AS (SELECT c, list({_FLOOR} ORDER BY i) AS v FROM (
                SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
                FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i) GROUP BY c)"""
            )
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} USING (c))")
    return f"""WITH {', '.join(steps)}
        SELECT vec_id, c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
            CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} USING (c)"""


def vector_codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    part = "v[p * len(v) // {n} + 1 : (p + 1) * len(v) // {n}]".format(n=parts)
    steps = [
        f"kept AS MATERIALIZED (SELECT vec_id, label, {_INTEGERS} AS v FROM embeddings WHERE {_FINITE})",
        f"parts AS MATERIALIZED (SELECT vec_id, p, {part} AS x FROM kept, range({parts}) AS t(p))",
        f"""b0 AS MATERIALIZED (SELECT p, e, x FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e
            FROM (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries})) USING (vec_id))""",
    ]
    for r in range(rounds + 1):
        near = f"SELECT vec_id, p, parts.x AS x, min({_apart('parts.x', f'b{r}.x')} * {entries} + e) AS best FROM parts JOIN b{r} USING (p) GROUP BY ALL"
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, p, x, best // {entries} AS d, best % {entries} AS e FROM ({near}))")
        if r < rounds:
            steps.append(
                f"""m{r} AS (SELECT p, e, list({_FLOOR} ORDER BY i) AS x FROM (
                SELECT p, e, i, CAST(sum(y) AS BIGINT) AS s, count(*) AS n
                FROM (SELECT p, e, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY p, e, i) GROUP BY p, e)"""
            )
            steps.append(f"b{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{r}.x, b{r}.x) AS x FROM b{r} LEFT JOIN m{r} USING (p, e))")
    return f"""WITH {', '.join(steps)},
        coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
            FROM a{rounds} GROUP BY vec_id)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
        FROM coded JOIN kept USING (vec_id)"""


_SPACED, _LETTERED = "[^\\x20\\x09-\\x0D]+", "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _words(pattern: str) -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lowered}, '{pattern}')"


def ngram_join(k: int = 4, percent: int = 85) -> str:
    """Pairs of all sets that share a shingle, and all that is reachable from each set."""
    grams = f"CASE WHEN len(w) >= {k} THEN [array_to_string(w[i : i + {k - 1}], ' ') FOR i IN range(1, len(w) - {k - 2})] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"
    return f"""WITH RECURSIVE words AS (SELECT doc_id, {_words(_SPACED)} AS w FROM documents),
        own AS MATERIALIZED (SELECT doc_id, list_sort(list_distinct({grams})) AS s FROM words),
        classes AS MATERIALIZED (SELECT s, min(doc_id) AS c, len(s) AS n FROM own WHERE len(s) > 0 GROUP BY s),
        posted AS MATERIALIZED (SELECT c, n, unnest(s) AS g FROM classes),
        pairs AS (SELECT a.c AS a, b.c AS b, a.n + b.n AS n, count(*) AS m FROM posted a JOIN posted b USING (g) WHERE a.c < b.c GROUP BY ALL),
        links AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * m >= {percent} * (n - m)),
        sides AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached(c, r) AS (SELECT c, c FROM classes UNION SELECT reached.c, sides.b FROM reached JOIN sides ON sides.a = reached.r),
        least AS (SELECT c, min(r) AS component_id FROM reached GROUP BY c)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
        FROM own LEFT JOIN classes USING (s) LEFT JOIN least USING (c)"""


def chat(learned: str = "assistant") -> str:
    hard = r"\### Assistant: </turn> ok"
    more = f"VALUES (-7, 0, 'user', '{hard}'), (-7, 1, 'assistant', '{hard}')"
    escaped = r"(2 * length({0}) - length(regexp_replace({0}, '[\\<>]', '', 'g')))"
    marks = len("<turn:>\n\n</turn>\n")
    return f"""WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
            FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL {more}))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY pos)) AS turns_sha256,
            CAST(sum(CASE WHEN r = '{learned}' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
            sha256(string_agg(CASE WHEN r = '{learned}' THEN t ELSE '' END, '' ORDER BY pos)) AS loss_sha256,
            CAST(sum({escaped.format('r')} + {escaped.format('t')} + {marks}) AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id"""


def decontaminate(window: int = 10) -> str:
    """Windows of every length that items have, joined as texts."""
    grams = "unnest([{{'p': i, 'g': array_to_string(w[i : i + {n} - 1], ' ')}} FOR i IN range(1, len(w) - {n} + 2)], recursive := true)"
    return f"""WITH docs AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS row, {_words(_LETTERED)} AS w FROM documents),
        items AS MATERIALIZED (SELECT item_id, w, least(len(w), {window}) AS n FROM (SELECT item_id, {_words(_LETTERED)} AS w FROM benchmark) WHERE len(w) > 0),
        tested AS MATERIALIZED (SELECT DISTINCT item_id, n, g FROM (SELECT item_id, n, {grams.format(n='n')} FROM items)),
        present AS (SELECT row, n, {grams.format(n='n')} FROM docs, (SELECT DISTINCT n FROM items)),
        met AS MATERIALIZED (SELECT row, p, n, item_id FROM present JOIN tested USING (n, g)),
        hits AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(p, p + n)) AS place FROM met) GROUP BY row),
        named AS (SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY row)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hits USING (row) LEFT JOIN named USING (row)"""
