"""SQL for DuckDB that gives the same rows as the operators' queries, where SQL can say it."""

from __future__ import annotations

from .quality import PUNCTUATION, STOP_WORDS
from .mixing import BLOCK_WORDS, GOLDEN, MIN_BLOCKS

BLANK = r"\x20\x09-\x0D"
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

QUALITY = rf"""
WITH words AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^{BLANK}]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{BLANK}]')) AS lines
  FROM documents
), grams AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS gram
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
), often AS (
  SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1
), covered AS (
  SELECT rid, sum(least(5, coalesce(following - i, 5))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS following FROM often) GROUP BY rid
), measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(w, lambda x: rtrim(lower(rtrim(x, '{PUNCTUATION}')), '') IN ({_STOP}))) AS n_stop_words,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclamations,
         length(regexp_replace(t, '\P{{Lu}}', '', 'g')) AS n_capitals
  FROM words LEFT JOIN covered c USING (rid)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         100 * word_chars < 200 * n_words OR 100 * word_chars > 1200 * n_words
         OR 100 * n_symbols > 10 * n_words OR 100 * n_exclamations > 30 * n_words
         OR 100 * n_capitals > 40 * word_chars
         OR (n_words >= 50 AND 100 * n_stop_words < 6 * n_words)
         OR 100 * n_dup_lines > 50 * n_lines AS broken
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT broken AS kept
FROM judged
"""

MIXING = rf"""
WITH sized AS (
  SELECT row_number() OVER () AS rid, doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^{BLANK}]+')) AS BIGINT) AS size
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(2 * sum(size) AS BIGINT) AS most,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), sums AS (
  SELECT *, row_number() OVER by_level AS place,
         coalesce(CAST(sum(most) OVER (by_level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS full_,
         CAST(sum(weight) OVER (by_level ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS open_,
         CAST(sum(source_size) OVER () AS BIGINT) * CAST(1.5 AS DOUBLE) AS words
  FROM totals WINDOW by_level AS (ORDER BY CAST(most AS DOUBLE) / weight, source NULLS LAST)
), level AS (
  SELECT * FROM sums WHERE (words - full_) / open_ <= CAST(most AS DOUBLE) / weight ORDER BY place LIMIT 1
), targets AS (
  SELECT s.source, s.source_size,
         coalesce(CASE WHEN s.place >= l.place THEN s.weight * (l.words - l.full_) / l.open_ ELSE CAST(s.most AS DOUBLE) END, 0.0) AS target
  FROM sums s LEFT JOIN level l ON true
), placed AS (
  SELECT doc_id, source, size, CAST(coalesce(sum(size) OVER (
           PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS FIRST, size, rid
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized
), quotas AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS quota,
         CAST(greatest(1, least({BLOCK_WORDS}, ceil(source_size / {MIN_BLOCKS}))) AS BIGINT) AS block_words FROM targets
), shares AS (
  SELECT source, block_words, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
           quota // source_size * CAST(ceil(source_size / block_words) AS BIGINT) + ceil((quota % source_size) / block_words) END AS BIGINT) AS slots
  FROM quotas
), spans AS (
  SELECT source, slots, total, below / total AS low, (below + slots) / total AS high
  FROM (SELECT source, slots, CAST(sum(slots) OVER () AS BIGINT) AS total, CAST(sum(slots) OVER (ORDER BY source NULLS LAST) - slots AS BIGINT) AS below
        FROM shares WHERE slots > 0)
), points AS (
  SELECT i, (i + 1) * CAST({GOLDEN} AS DOUBLE) - floor((i + 1) * CAST({GOLDEN} AS DOUBLE)) AS point
  FROM (SELECT unnest(range((SELECT max(total) FROM spans))) AS i)
), timed AS (
  SELECT source, slots, total, row_number() OVER (PARTITION BY source ORDER BY i) - 1 AS k, i AS position
  FROM points JOIN spans ON low <= point AND point < high
), slots AS (
  SELECT source, k, position FROM timed WHERE k < slots
  UNION ALL
  SELECT source, k, k + total FROM (SELECT s.source, s.total, unnest(range(coalesce(t.got, 0), s.slots)) AS k
    FROM spans s LEFT JOIN (SELECT source, least(max(slots), count(*)) AS got FROM timed GROUP BY source) t ON s.source IS NOT DISTINCT FROM t.source)
)
-- Blocks of {BLOCK_WORDS} words (at least {MIN_BLOCKS} a source) are taken in order, round after round, so a
-- document's words are taken once in each whole round and up to the end of the last one. Slots of a source follow each
-- other, so the first one to take a word of a document is the first round's slot of the block it starts in.
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN s.position END AS first_slot
FROM (SELECT p.*, q.source_size, q.target, q.block_words, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
         quota // source_size * size + greatest(0, least(size, quota % source_size - start)) END AS BIGINT) AS taken
      FROM placed p JOIN quotas q ON p.source IS NOT DISTINCT FROM q.source) d
LEFT JOIN slots s ON d.source IS NOT DISTINCT FROM s.source AND s.k = d.start // d.block_words
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(regexp_replace(replace(role, chr(92), chr(92) || chr(92)), '[\[<](/?INST\]|/s>)', '\0+', 'g'))
         + length(regexp_replace(replace(text, chr(92), chr(92) || chr(92)), '[\[<](/?INST\]|/s>)', '\0+', 'g')) + 17 AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_UPPER = "".join(map(chr, range(65, 91)))

DIVERGENCE = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS t
  FROM documents
), counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs
  FROM (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs)
  GROUP BY lang, source, term
), kept AS (
  SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term HAVING sum(docs) >= 10
), whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
  FROM kept
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS c
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), smoothed AS (
  SELECT *, 1 + (1000000000::HUGEINT * (c + 2))
            // (sum(c) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p
  FROM cells
), priced AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM smoothed a JOIN smoothed b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN priced v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, ((p - q) * (p - q)) // (p + q)
  FROM smoothed s JOIN whole w ON w.lang = s.lang AND w.term = s.term WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= 10
"""

ORACLE = {"op1_quality": QUALITY, "op2_mixing": MIXING, "op8_chat": CHAT, "op13_divergence": DIVERGENCE}
