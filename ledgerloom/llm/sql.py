"""The results of those operators that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from ledgerloom.llm.secrets import BASE, RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BYTES = "list_transform(range(1, octet_length(encode(w)) + 1), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i - 1, 2) AS BIGINT))"
#: The table of CRC-32, from its polynomial, and the checksum of the text w.
_REST = """rest AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i) ORDER BY i) AS x
              FROM range(256) t(i))"""
_CRC = f"xor(list_reduce({_BYTES}, lambda c, b: xor(c >> 8, rest.x[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"

QUALITY = rf"""
WITH {_REST},
d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, coalesce('=' || source, '') AS host,
             md5(coalesce(text, '')) AS fp FROM documents),
w AS (SELECT k, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
runs AS (SELECT k, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS run
         FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT k, i FROM runs QUALIFY count(*) OVER (PARTITION BY k, run) > 1),
repeated AS (SELECT k, count(DISTINCT i + j) AS n FROM twice, range(0, 3) r(j) GROUP BY k),
parts AS (SELECT k, host, fp, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
solid AS (SELECT k, count(*) - count(DISTINCT line) AS dup FROM parts
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
norms AS (SELECT * FROM (SELECT *, trim(regexp_replace(lower(line), '[^\p{{L}}]+', ' ', 'g')) AS norm FROM parts) WHERE norm <> ''),
own AS (SELECT DISTINCT host, fp, pos, line, norm FROM norms),
often AS (SELECT host, norm FROM own GROUP BY ALL HAVING count(DISTINCT fp) > 30),
held AS (SELECT * FROM own JOIN often USING (host, norm)),
one AS (SELECT host, fp, 'lines ' || string_agg(pos || ' ' || norm, chr(10) ORDER BY pos) AS whole FROM held GROUP BY host, fp),
rare AS (SELECT host, fp, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w
         FROM own ANTI JOIN often USING (host, norm) SEMI JOIN one USING (host, fp)),
threes AS (SELECT host, fp, array_to_string(w[i : i + 2], ' ') AS w FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM rare)),
sums AS (SELECT w, {_CRC} AS h FROM (SELECT DISTINCT w FROM threes), rest),
slots AS (SELECT host, fp, h % 8 AS slot, CAST(min(h) AS VARCHAR) AS h FROM threes JOIN sums USING (w) GROUP BY ALL),
low AS (SELECT host, fp, coalesce(l, [whole]) AS low FROM one LEFT JOIN (SELECT host, fp, list(h) AS l FROM slots GROUP BY host, fp) USING (host, fp)),
each AS (SELECT *, unnest(low) AS h FROM low),
leaders AS (SELECT host, h, min(fp) AS leader, arg_min(low, fp) AS low2 FROM each GROUP BY host, h),
labels AS (SELECT host, fp, min(leader) AS label FROM each JOIN leaders USING (host, h)
           WHERE len(list_intersect(low, low2)) >= 0.875 * greatest(len(low), len(low2)) GROUP BY host, fp),
hot AS (SELECT host, norm FROM held LEFT JOIN labels USING (host, fp) GROUP BY ALL HAVING count(DISTINCT coalesce(label, fp)) > 30),
cut AS (SELECT k, sum(length(line)) AS gone FROM norms JOIN hot USING (host, norm) GROUP BY k),
counts AS (SELECT doc_id, text, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                  length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
                  coalesce(dup, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, gone
           FROM d JOIN w USING (k) LEFT JOIN solid USING (k) LEFT JOIN repeated USING (k) LEFT JOIN cut USING (k)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(length(text) - gone < 200 OR length(text) - gone < 0.3 * length(text), FALSE) AS kept
FROM judged"""

_SAID = r"\### Assistant: </turn> ok"
_ORDER = "turn NULLS FIRST, role, text"
CHATS = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '{_SAID}'), (-7, 1, 'assistant', '{_SAID}'))),
o AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY {_ORDER}) IS DISTINCT FROM role AS first,
             length(text) + length(regexp_replace(text, '[^\\\\<>]', '', 'g')) AS text_chars,
             length(role) + length(regexp_replace(role, '[^\\\\<>]', '', 'g')) AS role_chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY {_ORDER})) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY {_ORDER}) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(text_chars + CASE WHEN first THEN length('<turn:') + role_chars + 2 + length('</turn>') + 1
                                  ELSE length('<next/>') END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
keys AS (SELECT DISTINCT item, n, array_to_string(w[p : p + n - 1], ' ') AS run
         FROM (SELECT item, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
runs AS (SELECT k, p, n, array_to_string(w[p : p + n - 1], ' ') AS run
         FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM keys) WHERE len(w) >= n)),
met AS (SELECT k, p, runs.n, item FROM runs JOIN keys ON runs.run = keys.run AND runs.n = keys.n),
hits AS (SELECT k, count(DISTINCT p + j) AS n_hit FROM (SELECT DISTINCT k, p, n FROM met), range(0, 13) r(j) WHERE j < n GROUP BY k),
items AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, item FROM met) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit > 0 AND 20 * n_hit >= len(w), FALSE) AS contaminated
FROM d LEFT JOIN hits USING (k) LEFT JOIN items USING (k)"""


def _spans(rank: int) -> str:
    """(k, start, rank, end, kind) of one rule's matches: what lies between them tells where they are."""
    rule = RULES[rank]
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""
    SELECT k, CAST(start AS BIGINT) AS start, {rank} AS rank, CAST(start + own AS BIGINT) AS stop, '{rule.kind}' AS kind
    FROM (SELECT k, held, own, sum(gap) OVER w + sum(own) OVER w - own AS start
          FROM (SELECT k, unnest(list_transform(regexp_extract_all(text, {pattern}), lambda x: length(x))) AS own,
                       unnest(list_transform(regexp_extract_all(text, {pattern}, {rule.group}), lambda x: length(x))) AS held,
                       unnest(list_transform(string_split_regex(text, {pattern})[:len(regexp_extract_all(text, {pattern}))], lambda x: length(x))) AS gap,
                       generate_subscripts(regexp_extract_all(text, {pattern}), 1) AS i
                FROM d WHERE regexp_matches(text, {pattern}))
          WINDOW w AS (PARTITION BY k ORDER BY i ROWS UNBOUNDED PRECEDING))
    WHERE held >= {rule.least}"""


_LISTED = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop)"
SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_spans(rank) for rank in range(len(RULES)))}),
told AS (SELECT k, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
                {_LISTED} FILTER (rank < {len(BASE)}) AS base, {_LISTED} AS spans FROM s GROUP BY k)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (k)"""

RESAMPLE = f"""
WITH {_REST},
d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
own AS (SELECT k, unnest(w) AS w FROM d),
aim AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
known AS (SELECT w, {_CRC} % 10000 AS bucket
          FROM (SELECT w FROM own UNION SELECT w FROM aim), rest),
s AS (SELECT bucket, count(*) AS n FROM own JOIN known USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM aim JOIN known USING (w) GROUP BY bucket),
gains AS (SELECT s.bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM own) + 10000 AS DOUBLE)
                 / (CAST(s.n + 1 AS DOUBLE) * CAST((SELECT count(*) FROM aim) + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT k, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM own JOIN known USING (w) JOIN gains USING (bucket) GROUP BY k),
scored AS (SELECT k, doc_id, len(w) AS n, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
                  (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT) AS score
           FROM d LEFT JOIN weights USING (k)),
placed AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () * 10 // 100 AS most FROM scored WHERE n >= 20)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CAST(CASE WHEN place <= most THEN place END AS BIGINT) AS rank
FROM scored LEFT JOIN placed USING (k)"""

ORACLES = {
    "op1_quality_rules": QUALITY,
    "op6_secret_scan": SECRETS,
    "op9_chat_format": CHATS,
    "op10_decontaminate": CONTAMINATION,
    "op13_importance_resampling": RESAMPLE,
}
