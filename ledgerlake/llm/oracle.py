"""The same results in DuckDB's SQL, for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op1_exact_top_k"] = """
WITH vectors AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

# Strings of 100 bytes as 200 hexadecimal digits; equal md5 sums stand for equal strings.
ORACLE["op8_suffix_array_dedup"] = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
    SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS s
    FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM docs)
),
later AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS place FROM strings
    ) WHERE place > 1
),
steps AS (
    SELECT doc_id, i, i - lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) > 100 AS new FROM later
),
runs AS (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM steps),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY doc_id, run),
cuts AS (
    SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS start, a AS stop FROM spans
    UNION ALL SELECT doc_id, max(b), 1000000000 FROM spans GROUP BY doc_id
),
kept AS (
    SELECT doc_id, string_agg(substr(h, 2 * start + 1, 2 * (stop - start)), '' ORDER BY start) AS h
    FROM cuts JOIN docs USING (doc_id) GROUP BY doc_id
),
removed AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, (len(docs.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.h, docs.h))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

ORACLE["op10_source_mixing"] = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
           ('0x' || substr(md5('17-' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS draw
    FROM documents
),
classes AS (
    SELECT source, floor(sqrt(size)) AS class, count(*) AS n, sum(size)::BIGINT AS words
    FROM sized GROUP BY ALL
),
sources AS (
    SELECT source, sum(words)::BIGINT AS words, 3 * sum(words)::BIGINT AS cap,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM classes GROUP BY source
),
levels AS (
    SELECT *, cap::DOUBLE / weight AS ratio,
           (sum(words) OVER () - coalesce(sum(cap) OVER (
               ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
           ), 0))::DOUBLE / sum(weight) OVER (
               ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING
           ) AS level
    FROM sources
),
water AS (SELECT level FROM levels WHERE level * weight < cap ORDER BY ratio, level LIMIT 1),
targets AS (
    SELECT source, words, CASE WHEN level * weight >= cap THEN cap::DOUBLE
           ELSE least(cap::DOUBLE, (SELECT level FROM water) * weight) END AS target,
           ('0x' || substr(md5('17-source-' || coalesce(source, '')), 1, 15))::BIGINT / 1152921504606846976.0::DOUBLE
               AS start
    FROM levels
),
epochs AS (SELECT *, CASE WHEN words > 0 THEN target / words ELSE 0.0 END AS epochs FROM targets),
strata AS (
    SELECT *, ceil(n / 256)::BIGINT AS cuts, coalesce(sum(n) OVER (
        PARTITION BY source ORDER BY class ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
    ), 0)::BIGINT AS base
    FROM classes
),
placed AS (
    SELECT s.*, e.words AS source_size, e.target, floor(e.epochs) AS whole, e.epochs - floor(e.epochs) AS part,
           e.start, c.n, c.base, c.cuts, s.draw % c.cuts AS cut
    FROM sized s JOIN strata c ON s.source IS NOT DISTINCT FROM c.source AND floor(sqrt(s.size)) = c.class
    JOIN epochs e ON s.source IS NOT DISTINCT FROM e.source
),
ordered AS (
    SELECT *, start + part * (base + (cut * n) / cuts) AS place, row_number() OVER (
        PARTITION BY source, floor(sqrt(size)), cut ORDER BY size, draw
    ) AS nth
    FROM placed
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       ((whole + floor(place + part * nth) - floor(place + part * (nth - 1))) * size)::BIGINT AS taken
FROM ordered
"""

ORACLE["op11_ranked_lexical_search"] = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
items AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
size AS (SELECT count(*)::BIGINT AS n_all, sum(len(terms))::BIGINT AS l_all FROM docs WHERE len(terms) > 0),
lengths AS (SELECT r, doc_id, 100 - 25 + ((25 * len(terms) * n_all) // l_all) AS m FROM docs, size WHERE len(terms) > 0),
postings AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) t GROUP BY r, term),
asked AS (SELECT q, item_id, term, count(*)::BIGINT AS n
    FROM (SELECT q, item_id, unnest(terms) AS term FROM items) t GROUP BY q, item_id, term),
lexicon AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * n_all + 2) / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term) t, size),
scored AS (SELECT q, item_id, r, doc_id, sum(n * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM asked JOIN lexicon USING (term) JOIN postings USING (term) JOIN lengths USING (r)
    GROUP BY q, item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
