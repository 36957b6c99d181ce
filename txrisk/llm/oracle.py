"""DuckDB twins of the queries of this package that SQL can express, written from their contracts."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""

LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i, len(l) AS n
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), hashed AS (
    SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT % 1000003 AS h FROM lines
), rolled AS (
    SELECT *, ((coalesce(lag(h, 2) OVER doc, 0) * 131071 + coalesce(lag(h, 1) OVER doc, 0)) % 1000003
        * 131071 + h) % 1000003 AS r
    FROM hashed WINDOW doc AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
    SELECT *, coalesce(sum(CASE WHEN r % 4 = 0 THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
    FROM rolled
), chunks AS (
    SELECT doc_id, chunk, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t FROM numbered GROUP BY ALL
), gone AS (
    SELECT doc_id, chunk, n FROM (
        SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, chunk) AS nth FROM chunks
        WHERE n > 1 AND regexp_matches(t, '[^\x20\x09-\x0D]')
    ) WHERE nth > 1
), per_doc AS (
    SELECT doc_id, sum(n)::BIGINT AS n_removed, count(*) AS n_chunks_removed FROM gone GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS t FROM numbered
    WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = numbered.doc_id AND g.chunk = numbered.chunk)
    GROUP BY doc_id
)
SELECT d.doc_id, len(string_split(coalesce(d.text, ''), chr(10))) AS n_lines,
    coalesce(p.n_removed, 0) AS n_removed, coalesce(p.n_chunks_removed, 0) AS n_chunks_removed,
    coalesce(k.t, '') AS text
FROM documents d LEFT JOIN per_doc p USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

SOURCE_MIX = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::BIGINT AS w
    FROM docs GROUP BY source
), filling AS (
    -- Each round gives the sources above their cap just that, and shares the rest among the others.
    SELECT 0 AS round, source, source_size, w, false AS filled, sum(source_size) OVER () AS total FROM sources
    UNION ALL
    SELECT round + 1, source, source_size, w, filled OR 3 * source_size * w_open <= w * left_over, total
    FROM (
        SELECT *, total - sum(CASE WHEN filled THEN 3 * source_size ELSE 0 END) OVER () AS left_over,
            sum(CASE WHEN filled THEN 0 ELSE w END) OVER () AS w_open
        FROM filling
    ) WHERE round < (SELECT count(*) FROM sources)
), targets AS (
    SELECT source, source_size, CASE WHEN filled THEN (3 * source_size)::DOUBLE ELSE
        (w * (total - sum(CASE WHEN filled THEN 3 * source_size ELSE 0 END) OVER ()))::DOUBLE
        / (sum(CASE WHEN filled THEN 0 ELSE w END) OVER ())::DOUBLE END AS target
    FROM filling WHERE round = (SELECT count(*) FROM sources)
), placed AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), passes AS (
    SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS full_passes FROM placed
)
SELECT doc_id, size, source_size, target,
    (full_passes * size + greatest(0, least(size, budget - full_passes * source_size - before)))::BIGINT AS taken
FROM passes
"""

CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), logs AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS LAST, role, md5(text)) AS log FROM turns
    GROUP BY conv_id
), firsts AS (
    SELECT log, min(conv_id) AS conv_id, count(*) AS n_copies FROM logs GROUP BY log
)
SELECT conv_id, len(log)::BIGINT AS n_turns, n_copies, list_aggregate(list_transform(log, lambda x:
    '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), 'string_agg', '') AS rendered
FROM firsts f WHERE NOT EXISTS (
    SELECT 1 FROM firsts o WHERE len(o.log) > len(f.log) AND o.log[1:len(f.log)] = f.log
)
"""

SUBSTRING_DEDUP = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i + 1:i + 20], ' ') AS t
    FROM (SELECT doc_id, w, unnest(range(len(w) - 19)) AS i FROM docs)
), repeats AS (
    SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS nth FROM windows)
    WHERE nth > 1
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs
), judged AS (
    SELECT doc_id, word, i, max(started) OVER (PARTITION BY doc_id ORDER BY i
        ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) IS NOT NULL AS removed
    FROM words LEFT JOIN (SELECT doc_id, i, i AS started FROM repeats) r USING (doc_id, i)
), per_doc AS (
    SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed,
        string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT removed) AS kept
    FROM judged GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN per_doc USING (doc_id)
"""

# The kinds of the secret scan in their order, with patterns.
SECRET_KINDS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
    "id": (
        r"""(?i)(client_?id|access_?id|key_?id|account|username|user|login)["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9@+/_.-]{3,})"""
    ),
    "key": r"[A-Za-z0-9+/_-]{20,}={0,2}",
    "endpoint": r"""https?://[^\x20\x09-\x0D"'<>]+""",
}


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def matches_of(kind: str) -> str:
    pattern = literal(SECRET_KINDS[kind])
    return f"""SELECT doc_id, '{kind}' AS kind, regexp_extract_all(t, {pattern}) AS m, string_split_regex(t, {pattern}) AS g
    FROM docs WHERE regexp_matches(t, {pattern})"""


SECRET_SCAN = rf"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS t FROM documents
), matches AS (
    {" UNION ALL ".join(map(matches_of, SECRET_KINDS))}
), pieces AS (
    SELECT doc_id, kind, unnest(m) AS match, unnest(g[1:len(m)]) AS gap, unnest(range(len(m))) AS i FROM matches
), placed AS (
    SELECT doc_id, kind, match, length(match) AS n,
        sum(length(gap) + length(match)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e
    FROM pieces
), spans AS (
    SELECT doc_id, kind, list_position({list(SECRET_KINDS)}, kind) AS r, (e - n)::BIGINT AS s, e::BIGINT AS e
    FROM placed WHERE CASE kind
        WHEN 'assign' THEN length(regexp_extract(match, {literal(SECRET_KINDS["assign"])}, 2)) >= 6
        WHEN 'access' THEN n >= 20
        WHEN 'hex' THEN n >= 24
        WHEN 'key' THEN regexp_matches(match, '[0-9]') AND regexp_matches(match, '[A-Za-z]')
        ELSE true END
), base AS (
    SELECT * FROM spans WHERE r <= 3
), weak AS (
    SELECT * FROM spans w WHERE r > 3
        AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b.s < w.e AND b.e > w.s)
), parts AS (
    SELECT * FROM base UNION ALL SELECT * FROM weak
), near AS (
    SELECT w.doc_id, w.kind, w.s, bool_or(p.kind IN ('id', 'access')) AS by_id,
        bool_or(p.kind IN ('key', 'assign', 'hex')) AS by_secret
    FROM weak w JOIN parts p ON p.doc_id = w.doc_id AND p.s - w.e <= 200 AND w.s - p.e <= 200
    GROUP BY ALL
), linked AS (
    SELECT * FROM base UNION ALL
    SELECT w.* FROM weak w JOIN near USING (doc_id, kind, s)
    WHERE CASE kind WHEN 'id' THEN by_secret WHEN 'key' THEN by_id ELSE by_id AND by_secret END
), per_doc AS (
    SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
        count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
        string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, r) FILTER (WHERE r <= 3) AS base,
        string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, r) AS spans
    FROM linked GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN per_doc USING (doc_id)
"""

PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, p FROM (
        SELECT lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'
        )) AS p FROM documents
    )
), words AS (
    SELECT lang, piece, unnest(w) AS w, unnest(range(len(w))) AS i
    FROM (SELECT lang, piece, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces)
), next AS (
    SELECT lang, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4, lead(w, 4) OVER o AS w5
    FROM words WINDOW o AS (PARTITION BY piece ORDER BY i)
), phrases AS (
    SELECT lang, [w] AS p FROM next
    UNION ALL SELECT lang, [w, w2] FROM next WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, [w, w2, w3] FROM next WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, [w, w2, w3, w4] FROM next WHERE w4 IS NOT NULL
    UNION ALL SELECT lang, [w, w2, w3, w4, w5] FROM next WHERE w5 IS NOT NULL
), counted AS (
    SELECT lang, p, count(*)::HUGEINT AS f FROM phrases GROUP BY ALL HAVING count(*) >= 100
), totals AS (
    SELECT lang, count(*)::HUGEINT AS n FROM words GROUP BY lang
), cuts AS (
    SELECT lang, p, f, unnest(range(1, len(p))) AS k FROM counted WHERE len(p) > 1
), scored AS (
    SELECT c.lang, c.p, c.f AS a, c.k, l.f AS l, r.f AS r, t.n, 1000 * c.f * t.n // (l.f * r.f) AS score
    FROM cuts c JOIN totals t USING (lang)
    JOIN counted l ON l.lang = c.lang AND l.p = c.p[1:c.k]
    JOIN counted r ON r.lang = c.lang AND r.p = c.p[c.k + 1:]
), weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inside AS (
    SELECT lang, p[i:j] AS p, max(f) AS longer
    FROM counted, range(1, 5) s(i), range(2, 6) e(j)
    WHERE j > i AND j <= len(p) AND j - i + 1 < len(p) GROUP BY ALL
), kept AS (
    SELECT w.*, array_to_string(p, ' ') AS phrase FROM weakest w LEFT JOIN inside USING (lang, p)
    WHERE longer IS NULL OR 100 * longer < 100 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l,
    r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""

ORACLES = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op2_line_dedup": LINE_DEDUP,
    "op3_source_mix": SOURCE_MIX,
    "op5_secret_scan": SECRET_SCAN,
    "op9_chat_format": CHAT_FORMAT,
    "op10_substring_dedup": SUBSTRING_DEDUP,
    "op13_phrase_collocations": PHRASES,
}
