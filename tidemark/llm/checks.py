"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS host,
           coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
win AS (
    SELECT rid, i, array_to_string(list_slice(w, i, i + 2), ' ') AS g
    FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (
    SELECT rid, count(DISTINCT i + k) AS n_repeat_words
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win),
         (SELECT unnest([0, 1, 2]) AS k)
    WHERE c > 1 GROUP BY rid),
raw AS (SELECT rid, host, t, unnest(string_split(t, chr(10))) AS line FROM d),
worded AS (
    SELECT rid, host, t, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw FROM raw
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY rid),
norm AS (
    SELECT rid, host, t, len(lw) AS n,
           translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') AS line
    FROM worded),
frequent AS (
    SELECT host, line FROM norm
    JOIN (SELECT host, count(DISTINCT t) AS texts FROM d GROUP BY host) USING (host)
    GROUP BY host, line, texts
    HAVING count(DISTINCT t) > 10 AND (count(DISTINCT t) * 100 > texts * 10
                                       OR count(DISTINCT t) > 30
                                          AND len(string_split(line, ' ')) >= 8)),
gone AS (
    SELECT rid, sum(n) AS removed_words FROM norm JOIN frequent USING (host, line) GROUP BY rid),
c AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words
    FROM d LEFT JOIN rep USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN gone USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND (n_words - removed_words) * 100 >= n_words * 50 AS kept FROM f
"""

OP5 = r"""
WITH d AS (
    SELECT doc_id, source AS raw_source, lang AS raw_lang, coalesce(lang, '') AS lang,
           coalesce(source, '') AS source,
           CASE WHEN try_cast(regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) AS INT) < 10
                THEN 'web'
                WHEN try_cast(regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) AS INT) < 15
                THEN 'books' ELSE 'reference' END AS domain,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)
               AS n_tokens
    FROM documents),
leaves AS (
    SELECT domain, lang, source, sum(n_tokens) AS tokens, 4 * sum(n_tokens) AS room
    FROM d GROUP BY domain, lang, source),
n1 AS (
    SELECT domain, sum(room) AS room, sum(sum(tokens)) OVER () AS given,
           CASE domain WHEN 'web' THEN 60 WHEN 'books' THEN 25 ELSE 15 END AS weight
    FROM leaves GROUP BY domain),
r1 AS (
    SELECT *, (given - coalesce(sum(room) OVER (ORDER BY room::DOUBLE / weight, domain
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
              / sum(weight) OVER (ORDER BY room::DOUBLE / weight, domain
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM n1),
b1 AS (
    SELECT domain, CASE WHEN room::DOUBLE / weight > rate
        THEN CAST(floor(max(CASE WHEN room::DOUBLE / weight > rate THEN rate END) OVER () * weight)
                  AS BIGINT)
        ELSE room END AS given FROM r1),
n2 AS (
    SELECT domain, lang, sum(room) AS room,
           CASE domain || '/' || lang WHEN 'web/en' THEN 5 WHEN 'web/de' THEN 2
                WHEN 'web/fr' THEN 2 WHEN 'books/en' THEN 3 WHEN 'reference/en' THEN 2
                ELSE 1 END AS weight
    FROM leaves GROUP BY domain, lang),
r2 AS (
    SELECT *, (given - coalesce(sum(room) OVER (PARTITION BY domain
                   ORDER BY room::DOUBLE / weight, lang
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
              / sum(weight) OVER (PARTITION BY domain ORDER BY room::DOUBLE / weight, lang
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
    FROM n2 JOIN b1 USING (domain)),
b2 AS (
    SELECT domain, lang, CASE WHEN room::DOUBLE / weight > rate
        THEN CAST(floor(max(CASE WHEN room::DOUBLE / weight > rate THEN rate END)
                        OVER (PARTITION BY domain) * weight) AS BIGINT)
        ELSE room END AS given FROM r2),
n3 AS (
    SELECT domain, lang, source, room, tokens,
           CASE WHEN domain = 'web' AND lang = 'en' AND source = 'src0' THEN 2 ELSE 1 END AS weight
    FROM leaves),
r3 AS (
    SELECT *, (given - coalesce(sum(room) OVER (PARTITION BY domain, lang
                   ORDER BY room::DOUBLE / weight, source
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
              / sum(weight) OVER (PARTITION BY domain, lang
                   ORDER BY room::DOUBLE / weight, source
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
    FROM n3 JOIN b2 USING (domain, lang)),
b3 AS (
    SELECT domain, lang, source, tokens, CASE WHEN room::DOUBLE / weight > rate
        THEN CAST(floor(max(CASE WHEN room::DOUBLE / weight > rate THEN rate END)
                        OVER (PARTITION BY domain, lang) * weight) AS BIGINT)
        ELSE room END AS budget FROM r3),
e AS (
    SELECT *, CASE WHEN tokens > 0 THEN CAST(budget // tokens AS INT) ELSE 0 END AS epochs FROM b3),
k AS (
    SELECT d.*, e.epochs, e.budget - e.epochs * e.tokens AS remains,
           substr(md5('17:' || e.epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)
               AS key
    FROM d JOIN e USING (domain, lang, source)),
p AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key)
              - sum(n_tokens) OVER (PARTITION BY domain, lang, source, key) AS before FROM k),
t AS (SELECT *, epochs + CASE WHEN remains > 0 AND before < remains THEN 1 ELSE 0 END AS times FROM p)
SELECT doc_id, domain, raw_lang AS lang, raw_source AS source, n_tokens, CAST(epoch AS INT) AS epoch
FROM (SELECT *, unnest(range(times)) AS epoch FROM t)
"""

# Holds where no bucket is still too large after all 48 bits.
OP7 = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, strlen(coalesce(text, '')) AS n_bytes,
           ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))),
                           1, 12))::BIGINT AS h
    FROM documents),
n AS (SELECT *, unnest(range(49)) AS depth FROM d),
s AS (SELECT *, sum(n_bytes) OVER (PARTITION BY depth, h >> (48 - depth)) AS size FROM n)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(local_depth AS INT) AS local_depth,
       CASE WHEN local_depth = 0 THEN ''
            ELSE lpad(bin(h >> (48 - local_depth)), CAST(local_depth AS INT), '0') END AS shard,
       0 AS page
FROM (SELECT rid, doc_id, h, n_bytes, min(depth) AS local_depth FROM s
      WHERE size <= 1048576 GROUP BY rid, doc_id, h, n_bytes)
"""

OP10 = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
    SELECT *, replace(replace(replace(t, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>') AS et,
           replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'),
                   ': ', ':\ ') AS er
    FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), ''
                         ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
       CAST(coalesce(sum(length(t)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role, t)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(er) + length(et) + 14) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP12 = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents),
s AS (
    SELECT count(*) FILTER (len(t) > 0) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM d),
b AS (SELECT row_number() OVER () AS iid, item_id, text FROM benchmark),
i AS (
    SELECT iid, item_id,
           unnest(list_distinct(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
    FROM b),
o AS (SELECT rid, unnest(t) AS term FROM d),
f AS (
    SELECT rid, term, count(*) AS tf FROM o SEMI JOIN i USING (term) GROUP BY rid, term),
w AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1)))
                      AS BIGINT) AS w
    FROM f, s GROUP BY term, docs),
m AS (SELECT rid, doc_id, 100 - 90 + (90 * len(t) * docs) // terms AS m FROM d, s WHERE len(t) > 0),
scored AS (
    SELECT iid, item_id, rid, doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM i JOIN f USING (term) JOIN w USING (term) JOIN m USING (rid)
    GROUP BY iid, item_id, rid, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM scored WHERE score > 0)
WHERE rank <= 10
"""

CHECK_SQL: dict[str, str] = {
    "op2_line_frequency_rules": OP2,
    "op5_hierarchical_mixing": OP5,
    "op7_extendible_hashing": OP7,
    "op10_chat_formatting": OP10,
    "op12_dual_tree_ranking": OP12,
}
