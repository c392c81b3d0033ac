"""SQL for the queries that SQL can express; the others are tested against plain code."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {
    "op3_warc": """
        WITH p AS (
          SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
            sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (
          SELECT payload_digest, min(page_id) AS first_id FROM p
          WHERE payload_bytes >= 100 GROUP BY 1),
        r AS (
          SELECT p.*, first_id, payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id AS again
          FROM p LEFT JOIN f USING (payload_digest))
        SELECT page_id, payload_bytes, payload_digest,
          CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN again THEN first_id END AS refers_to
        FROM r""",
    "op9_chat": r"""
        WITH c AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations
          UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
          UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        g AS (
          SELECT conv_id, count(*) AS n,
            list(role ORDER BY turn NULLS FIRST, role, said) AS roles,
            string_agg(role || chr(10) || said || chr(10), '' ORDER BY turn NULLS FIRST, role, said) AS turns,
            coalesce(string_agg(said, '' ORDER BY turn NULLS FIRST, role, said)
              FILTER (role = 'assistant'), '') AS learned,
            -- Marks of a turn take 23 characters, and each < or [ one more.
            sum(23 + 2 * length(role || said)
              - length(replace(replace(role || said, '<', ''), '[', ''))) AS marked
          FROM c GROUP BY conv_id)
        SELECT conv_id, n AS n_turns, sha256(turns) AS turns_sha256,
          CAST(length(learned) AS BIGINT) AS loss_chars, sha256(learned) AS loss_sha256,
          CAST(marked AS BIGINT) AS formatted_chars,
          CASE WHEN roles = ['user', 'assistant'] THEN 'prompt'
            WHEN roles = ['system', 'user', 'assistant'] THEN 'instruction_system'
            WHEN len(list_filter(roles, lambda r: r NOT IN ('system', 'user', 'assistant'))) = 0
              THEN 'conversations'
            ELSE 'messages' END AS layout
        FROM g""",
    "op12_collocations": r"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        grams AS (
          SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: list_slice(w, i, i + m - 1))) AS g
          FROM words, range(1, 5) AS lengths(m) WHERE len(w) >= m),
        f AS (
          SELECT lang, CAST(m AS INTEGER) AS m, g, count(*) AS n FROM grams GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
        candidates AS (SELECT lang, m, g, n AS a FROM f WHERE m > 1 AND n >= 30),
        cuts AS (
          SELECT c.lang, c.g, c.m, c.a, k, CAST(l.n AS BIGINT) AS l, CAST(r.n AS BIGINT) AS r,
            CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(l.n AS HUGEINT) + r.n) AS BIGINT) AS score
          FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) AS c
          JOIN f AS l ON l.lang = c.lang AND l.g = list_slice(c.g, 1, k)
          JOIN f AS r ON r.lang = c.lang AND r.g = list_slice(c.g, k + 1, c.m)),
        best AS (
          SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
        inner_parts AS (
          SELECT lang, a, unnest([list_slice(g, i, i + n - 1) FOR i IN range(1, m - n + 2)]) AS g
          FROM (SELECT *, unnest(range(2, m)) AS n FROM candidates WHERE m > 2)),
        longer AS (SELECT lang, g, max(a) AS most FROM inner_parts GROUP BY lang, g),
        kept AS (
          SELECT b.* FROM best AS b LEFT JOIN longer AS x ON x.lang = b.lang AND x.g = b.g
          WHERE most IS NULL OR CAST(most AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80),
        ranked AS (
          SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS INTEGER) AS rank,
            array_to_string(g, ' ') AS phrase, CAST(a AS BIGINT) AS a, l, r, score FROM kept)
        SELECT lang, rank, phrase, a, l, r, totals.n, score FROM ranked JOIN totals USING (lang)
        WHERE rank <= 2000""",
    "op13_divergence": r"""
        WITH d AS (
          SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w,
            row_number() OVER () AS doc
          FROM documents),
        groups AS (SELECT DISTINCT lang, source FROM d),
        tf AS (
          SELECT lang, source, doc, term, count(*) AS n
          FROM (SELECT lang, source, doc, unnest(w) AS term FROM d) GROUP BY ALL),
        kept AS (
          SELECT lang, term, CAST(sum(n) AS HUGEINT) AS total FROM tf GROUP BY ALL HAVING count(*) >= 10),
        v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
        c AS (
          SELECT lang, source, term, CAST(sum(n) AS HUGEINT) AS n
          FROM tf JOIN kept USING (lang, term) GROUP BY ALL),
        sizes AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
        p AS (
          SELECT lang, source, term, coalesce(c.n, 0) AS n,
            1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (coalesce(sizes.n, 0) + 2 * v.v) AS p,
            1 + (1000000000 * (total + 2)) // (v.n + 2 * v.v) AS q
          FROM groups JOIN kept USING (lang) JOIN v USING (lang)
          LEFT JOIN sizes USING (lang, source) LEFT JOIN c USING (lang, source, term)),
        sums AS (
          SELECT a.lang, a.source, b.source AS item,
            sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
          GROUP BY ALL),
        results AS (
          SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
            CAST(coalesce(value, 0) AS BIGINT) AS value
          FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
          UNION ALL
          SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT)
          FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value,
          CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM results QUALIFY part = 'pair' OR rank <= 10""",
}
