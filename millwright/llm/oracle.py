"""DuckDB statements that give the rows of those queries that SQL can express.

They follow the definitions of the results, not the operators' ways: all windows, all distances,
all n-grams.
"""

from __future__ import annotations


def following(word: str, n: int, order: str) -> str:
    """A word and the n - 1 after it, joined by spaces."""
    parts = ", ".join(
        word if i == 0 else f"lead({word}, {i}) OVER ({order})" for i in range(n)
    )
    return f"concat_ws(' ', {parts})"


def passages(width: int = 13) -> str:
    order = "PARTITION BY doc_id ORDER BY place"
    return f"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        words AS (
            SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place, len(w) AS n
            FROM split),
        shown AS (
            SELECT doc_id, place, n, {following('word', width, order)} AS passage FROM words),
        windows AS (SELECT * FROM shown WHERE place <= n - {width - 1}),
        firsts AS (SELECT passage, min(doc_id) AS first_id FROM windows GROUP BY passage),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(place, place + {width})) AS place
            FROM windows JOIN firsts USING (passage) WHERE doc_id > first_id),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
            FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM split LEFT JOIN kept USING (doc_id)"""


def codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    ctes = [f"""kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * x) AS BIGINT)) AS v,
                   CAST(len(embedding) // {parts} AS INTEGER) AS size
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))""",
        f"""pieces AS (
            SELECT vec_id, p, v[p * size + 1 : (p + 1) * size] AS x
            FROM kept, range({parts}) parts(p))""",
        f"""firsts AS (
            SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e
            FROM kept QUALIFY e < {entries})""",
        "book_0 AS (SELECT p, e, x AS c FROM pieces JOIN firsts USING (vec_id))"]
    for turn in range(rounds + 1):
        # d * 256 + e is least for the least distance and, among equals, the least entry
        ctes.append(f"""near_{turn} AS MATERIALIZED (
            SELECT vec_id, p, min(256 * list_sum(list_transform(list_zip(x, c),
                       lambda z: (z[1] - z[2]) * (z[1] - z[2]))) + e) AS best
            FROM pieces JOIN book_{turn} USING (p) GROUP BY vec_id, p)""")
        if turn < rounds:
            ctes.append(f"""means_{turn} AS (
                SELECT p, e, list(CAST(m AS BIGINT) ORDER BY i) AS c
                FROM (SELECT p, e, i, floor(CAST(sum(y) AS DOUBLE) / count(*)) AS m
                      FROM (SELECT p, CAST(best % 256 AS BIGINT) AS e, unnest(x) AS y,
                                   unnest(range(len(x))) AS i
                            FROM near_{turn} JOIN pieces USING (vec_id, p))
                      GROUP BY p, e, i)
                GROUP BY p, e)""")
            ctes.append(f"""book_{turn + 1} AS MATERIALIZED (
                SELECT p, e, coalesce(m.c, b.c) AS c
                FROM book_{turn} b LEFT JOIN means_{turn} m USING (p, e))""")
    return f"""
        WITH {', '.join(ctes)},
        coded AS (
            SELECT vec_id, string_agg(printf('%02x', CAST(best % 256 AS INTEGER)), '' ORDER BY p) AS code,
                   CAST(sum(CAST(best AS BIGINT) // 256) AS BIGINT) AS error
            FROM near_{rounds} GROUP BY vec_id)
        SELECT vec_id, code, error,
               CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e))
                FROM book_{rounds}) AS codebooks_sha256
        FROM coded JOIN kept USING (vec_id)"""


def phrases(longest: int = 5, min_count: int = 100, top: int = 2000) -> str:
    order = "PARTITION BY piece ORDER BY place"
    lower = "abcdefghijklmnopqrstuvwxyz"
    grams = " UNION ALL ".join(
        f"SELECT lang, {n} AS k, {following('word', n, order)} AS phrase,"
        f" place <= size - {n - 1} AS whole FROM words"
        for n in range(1, longest + 1)
    )
    return f"""
        WITH texts AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), '{lower.upper()}', '{lower}') AS text
            FROM documents),
        cut AS (
            SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS body FROM texts),
        split AS (
            SELECT lang, row_number() OVER () AS piece,
                   regexp_extract_all(body, '[^\\x20\\x09]+') AS w FROM cut),
        words AS (
            SELECT lang, piece, len(w) AS size, unnest(w) AS word,
                   unnest(range(1, len(w) + 1)) AS place
            FROM split),
        totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
        counts AS MATERIALIZED (
            SELECT lang, k, phrase, count(*) AS f FROM ({grams}) WHERE whole
            GROUP BY lang, k, phrase HAVING count(*) >= {min_count}),
        candidates AS (
            SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
        cuts AS (
            SELECT c.lang, c.phrase, c.a, c.k, first_words, l.f AS l, r.f AS r, n,
                   CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT)
                     AS score
            FROM candidates c JOIN range(1, {longest}) places(first_words)
              ON first_words < c.k
            JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(w[1 : first_words], ' ')
            JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(w[first_words + 1 : c.k], ' ')
            JOIN totals t ON t.lang = c.lang),
        lowest AS (
            SELECT * FROM cuts
            QUALIFY 1 = row_number() OVER (PARTITION BY lang, phrase ORDER BY score, first_words)),
        inside AS (
            SELECT lang, array_to_string(w[b : e], ' ') AS phrase, max(a) AS longer
            FROM candidates, range(1, {longest + 1}) begins(b), range(1, {longest + 1}) ends(e)
            WHERE b <= e AND e <= k AND e - b + 1 < k GROUP BY ALL)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM lowest LEFT JOIN inside USING (lang, phrase)
        WHERE longer IS NULL OR longer < a
        QUALIFY rank <= {top}"""


STATEMENTS = {
    "op11_doubling_passages": passages(),
    "op12_net_bound_codes": codes(),
    "op13_quotient_phrases": phrases(),
}
