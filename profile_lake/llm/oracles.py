"""SQL of the queries that SQL can express, for DuckDB.

Licence scoring, language scores and merges of a vocabulary are not among them: their
tests compare with plain versions, held-out labels and the tokenizer library.
"""

from __future__ import annotations

_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_QUALITY = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '{_SPACED}') AS words FROM d),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{_SPACED}') GROUP BY doc_id),
each AS (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS pos FROM w),
five AS (
  SELECT doc_id, pos, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
    lead(word, 4) OVER o) AS gram, lead(word, 4) OVER o AS last
  FROM each WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
grams AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS often FROM five WHERE last IS NOT NULL),
repeated AS (
  SELECT doc_id, count(DISTINCT word) AS n_repeat_words
  FROM (SELECT doc_id, unnest(generate_series(pos, pos + 4)) AS word FROM grams WHERE often > 1) GROUP BY doc_id),
measured AS (
  SELECT w.doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)),
flagged AS (
  SELECT *, n_words < 10 AS few, 100 * n_repeat_words > 20 * n_words AS rep FROM measured),
hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (few) AS few, count(*) FILTER (rep) AS rep
  FROM flagged WHERE source IS NOT NULL GROUP BY source),
rates AS (SELECT source, n, unnest([few, rep]) AS broke, unnest(['few', 'rep']) AS rule FROM hosts),
moments AS (SELECT rule, avg(broke / n) AS m, var_pop(broke / n) AS v FROM rates GROUP BY rule),
priors AS (
  SELECT rule, m, least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 10000 END, 1), 10000) AS weight
  FROM moments),
rejected AS (
  SELECT DISTINCT source FROM rates JOIN priors USING (rule) WHERE (broke + m * weight) / (n + weight) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few OR rep AS base_failed,
  NOT (few OR rep) AND source IS DISTINCT FROM r.host AS kept
FROM flagged f LEFT JOIN (SELECT source AS host FROM rejected) r ON r.host = f.source"""

_SUFFIXES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY string ORDER BY doc_id, pos) AS nth
  FROM (
    SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, 200)) AS string
    FROM (SELECT doc_id, h, unnest(generate_series(0, length(h) // 2 - 100)) AS pos FROM d))),
later AS (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM starts WHERE nth > 1),
runs AS (
  SELECT doc_id, pos, sum(CASE WHEN before IS NULL OR pos > before + 100 THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM later),
spans AS (SELECT doc_id, run, min(pos) AS lo, max(pos) + 100 AS hi FROM runs GROUP BY doc_id, run),
cut AS (
  SELECT doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans, list(lo ORDER BY lo) AS los,
    list(hi ORDER BY lo) AS his FROM spans GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, d.h, n_removed, n_spans,
    list_concat([0], coalesce(his, [])) AS froms, list_append(coalesce(los, []), length(h) // 2) AS tos
  FROM d LEFT JOIN cut USING (doc_id))
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(array_to_string(list_transform(list_zip(froms, tos),
    lambda p: substr(h, 2 * p[1] + 1, 2 * (p[2] - p[1]))), ''))) AS kept_sha256
FROM kept"""

_PII_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[A-Z0-9]{1,3})?\b",
}
_PROPOSED = " UNION ALL ".join(
    f"""SELECT doc_id, {number} AS kind, '{name}' AS name, unnest(string_split_regex(t, '{pattern}')) AS gap,
  unnest(regexp_extract_all(t, '{pattern}')) AS hit, unnest(generate_series(1, len(t) + 1)) AS pos
  FROM d WHERE regexp_matches(t, '{pattern}')"""
    for number, (name, pattern) in enumerate(_PII_KINDS.items())
)
_PII = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
proposed AS (SELECT * FROM ({_PROPOSED}) WHERE hit IS NOT NULL),
placed AS (
  SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY pos)::BIGINT AS stop,
    regexp_replace(hit, '[^0-9]', '', 'g') AS digits, replace(hit, ' ', '') AS plain FROM proposed),
good AS (
  SELECT doc_id, kind, name, stop - length(hit) AS start, stop FROM placed
  WHERE CASE name
    WHEN 'email' THEN TRUE
    WHEN 'ip' THEN list_max(list_transform(string_split(hit, '.'), lambda p: coalesce(TRY_CAST(p AS HUGEINT), 256))) <= 255
    WHEN 'card' THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(
      generate_series(1, length(digits)), lambda i: CASE WHEN i % 2 = 1 THEN ascii(digits[-i]) - 48
        ELSE (2 * (ascii(digits[-i]) - 48)) // 10 + (2 * (ascii(digits[-i]) - 48)) % 10 END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 10 AND 15
    ELSE length(plain) BETWEEN 15 AND 34 AND list_reduce(list_concat([0], list_transform(
      generate_series(1, length(plain)), lambda i: ascii((plain[5:] || plain[:4])[i]))),
      lambda acc, c: CASE WHEN c < 58 THEN acc * 10 + c - 48 ELSE acc * 100 + c - 55 END % 97) = 1 END),
found AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip,
    count(*) FILTER (kind = 2) AS n_card, count(*) FILTER (kind = 3) AS n_phone,
    string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 4) AS base,
    string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans
  FROM good GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found USING (doc_id)"""

_FIXITY_LEVELS = 9
# A level: places join while there is more than one, then values of page_id.
_NODES = """SELECT side, page, place, min(lo) AS lo, max(hi) AS hi,
  sha256(string_agg(concat_ws(':', child, spot, lo - first, hi - first, digest), ',' ORDER BY child NULLS FIRST, spot)) AS digest
FROM (SELECT *, min(lo) OVER (PARTITION BY side, page, place) AS first
  FROM (SELECT side, page AS child, place AS spot, lo, hi, digest,
      CASE WHEN {level} <= places THEN page ELSE page >> 4 END AS page,
      CASE WHEN {level} <= places THEN place >> 4 ELSE place END AS place FROM level_{below}, depth))
GROUP BY side, page, place"""
_FIXITY = f"""
WITH pages_ AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
    coalesce(CAST(page_id AS VARCHAR), '') AS id FROM pages),
versions AS (
  SELECT *, CASE WHEN starts_with(md5(id), '0') THEN '?' || html[2:] ELSE html END AS other FROM pages_),
records AS (
  SELECT 'one' AS side, page_id, sha256(record) AS digest, octet_length(encode(record)) AS n
  FROM (SELECT *, {{record}} AS record FROM versions)
  UNION ALL
  SELECT 'two', page_id, sha256(record), octet_length(encode(record))
  FROM (SELECT *, {{damaged}} AS record FROM versions WHERE NOT starts_with(md5(id), '1f'))),
level_0 AS (
  SELECT side, page_id AS page, row_number() OVER (PARTITION BY side, page_id ORDER BY digest) - 1 AS place,
    (sum(n) OVER w - n)::BIGINT AS lo, (sum(n) OVER w)::BIGINT AS hi, digest
  FROM records WINDOW w AS (PARTITION BY side ORDER BY page_id NULLS FIRST, digest ROWS UNBOUNDED PRECEDING)),
depth AS MATERIALIZED (
  SELECT (SELECT min(k) FROM range(17) r(k) WHERE (last >> (4 * k)) = 0) AS places,
    (SELECT min(k) FROM range(17) r(k) WHERE (low >> (4 * k)) = (high >> (4 * k))) AS pages
  FROM (SELECT max(place) AS last, min(page) AS low, max(page) AS high FROM level_0)),
{", ".join(f"level_{n} AS MATERIALIZED ({_NODES.format(level=n, below=n - 1)})" for n in range(1, _FIXITY_LEVELS + 1))},
every AS (
{" UNION ALL ".join(f"SELECT {n} AS level, * FROM level_{n}" for n in range(_FIXITY_LEVELS + 1))})
SELECT level, page, place, o.lo AS "start", o.hi AS "end", o.digest, t.lo AS found_start, t.hi AS found_end,
  t.digest AS found_digest
FROM (SELECT * FROM every WHERE side = 'one') o FULL JOIN (SELECT * FROM every WHERE side = 'two') t
  USING (level, page, place)
WHERE o.digest IS DISTINCT FROM t.digest AND level <= (SELECT places + pages FROM depth)"""


def _record_sql(body: str) -> str:
    line = "chr(13) || chr(10)"
    return (
        f"'WARC/1.0' || {line} || 'WARC-Type: response' || {line} || 'WARC-Record-ID: <urn:page:' || id || '>' || {line} "
        f"|| 'WARC-Target-URI: ' || url || {line} || 'Content-Length: ' || octet_length(encode({body})) || {line} || {line} "
        f"|| {body} || {line} || {line}"
    )


_DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS words FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_ALNUM}') AS words FROM benchmark),
windows AS (
  SELECT item, least(len(words), 10) AS n, words[pos:pos + least(len(words), 10) - 1] AS w
  FROM (SELECT item, words, unnest(generate_series(1, len(words) - least(len(words), 10) + 1)) AS pos
    FROM i WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, pos, words[pos:pos + n - 1] AS w
  FROM (SELECT doc_id, n, words, unnest(generate_series(1, len(words) - n + 1)) AS pos FROM d, sizes WHERE len(words) >= n)),
hits AS (SELECT doc_id, p.n, pos, item FROM places p JOIN windows USING (w)),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id),
covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(pos, pos + n - 1)) AS word FROM hits) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

_REPEATS = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS words FROM documents),
windows AS (
  SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY key) < doc_id AS again
  FROM (
    SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) AS key
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS pos FROM d))),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + 49)) AS place FROM windows WHERE again),
words AS (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS place FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS kept
  FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(words[pos:pos + 3], ' ')) AS s
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 3, 1))) AS pos FROM d WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS one, b.doc_id AS two FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.two FROM reached r JOIN links l ON l.one = r.other)
SELECT doc_id, any_value(coalesce(n, 0)) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""

# CRC-32 of a list of byte values: the table follows from its polynomial.
_CRC_TABLE = """
crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
    ORDER BY i) AS steps FROM range(256) t(i))"""


def _crc32(binary: str) -> str:
    """Unsigned CRC-32 of a BLOB expression, in the presence of `crc_table`."""
    values = f"list_transform(regexp_extract_all(hex({binary}), '..'), lambda x: ('0x' || x)::BIGINT)"
    step = "lambda c, x: xor(c >> 8, steps[xor(c & 255, x) + 1])"
    return f"xor(list_reduce({values}, {step}, 4294967295::BIGINT), 4294967295)"


_SHARDING = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
  SELECT doc_id, octet_length(t) + 8 AS size, {_crc32("t")} AS text_crc32, sha256(t) AS digest
  FROM (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents), crc_table),
placed AS (
  SELECT *, sum(size) OVER o - size AS spot, row_number() OVER o - 1 AS number, lag(digest) OVER o AS before
  FROM d WINDOW o AS (ORDER BY digest, doc_id ROWS UNBOUNDED PRECEDING)),
starts AS MATERIALIZED (SELECT spot::BIGINT AS spot FROM placed WHERE before IS DISTINCT FROM digest),
borders AS MATERIALIZED (
  SELECT list_append((SELECT list(spot ORDER BY spot) FROM starts), total) AS b, total
  FROM (SELECT sum(size)::BIGINT AS total FROM d)),
search(low, high) AS (
  SELECT (total + 23) // 24, total FROM borders
  UNION ALL
  SELECT CASE WHEN fits THEN low ELSE middle + 1 END, CASE WHEN fits THEN middle ELSE high END
  FROM (
    SELECT low, high, middle, list_reduce(range(24), lambda here, step:
      list_max(list_filter(b, lambda s: s <= here + middle)), 0::BIGINT) = total AS fits
    FROM (SELECT low, high, (low + high) // 2 AS middle FROM search WHERE low < high), borders)),
capacity AS MATERIALIZED (SELECT low AS c FROM search WHERE low = high),
latest(k, spot) AS (
  SELECT 24, total FROM borders
  UNION ALL
  SELECT k - 1, list_min(list_filter(b, lambda s: s >= spot - c)) FROM latest, borders, capacity WHERE k > 1),
needed AS MATERIALIZED (SELECT * FROM latest),
cuts(k, spot) AS (
  SELECT 0, 0::BIGINT
  UNION ALL
  SELECT k + 1, least(total, greatest(needed_at, CASE WHEN share > spot THEN share ELSE
    coalesce(list_min(list_filter(b, lambda s: s > spot)), total) END))
  FROM (
    SELECT c.k, c.spot, n.spot AS needed_at, b, total,
      list_max(list_filter(b, lambda s: s <= c.spot + (total - c.spot + 23 - c.k) // (24 - c.k))) AS share
    FROM cuts c JOIN needed n ON n.k = c.k + 1, borders WHERE c.k < 23)),
cut_list AS MATERIALIZED (SELECT list(spot) AS cut FROM cuts WHERE k > 0),
named AS (SELECT p.*, len(list_filter(cut, lambda x: x <= p.spot)) AS shard FROM placed p, cut_list)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY number) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM named"""

_RUN = r"[A-Za-z\x{C0}-\x{FF}]+"
_SPELLING = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '{_RUN}')) AS run FROM documents)
  GROUP BY doc_id, run),
hashed AS (SELECT run, n, {_crc32("encode(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM runs, crc_table),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, n FROM hashed)
  WHERE len(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS MATERIALIZED (
  SELECT DISTINCT word, n, pos, word[:pos - 1] || word[pos + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS pos FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (rest, pos) WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON b.word = a.rest
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON b.word = a.rest),
best AS (
  SELECT word, n, count(*) AS n_near, max(other_n) AS top, min(other) FILTER (other_n = top_n) AS form
  FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS top_n FROM near) GROUP BY word, n),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * w.n THEN form END AS form,
    CASE WHEN top >= 2 * w.n THEN top END AS form_n
  FROM words w LEFT JOIN best USING (word)),
up(word, root, next) AS (
  SELECT word, word, form FROM formed
  UNION ALL SELECT up.word, f.word, f.form FROM up JOIN formed f ON f.word = up.next)
SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n
FROM formed f JOIN up ON up.word = f.word AND up.next IS NULL"""

ORACLES: dict[str, str] = {
    "op1_quality": _QUALITY,
    "op4_suffixes": _SUFFIXES,
    "op5_pii": _PII,
    "op7_fixity": _FIXITY.replace("{record}", _record_sql("html")).replace("{damaged}", _record_sql("other")),
    "op8_decontaminate": _DECONTAMINATE,
    "op9_repeats": _REPEATS,
    "op10_jaccard": _JACCARD,
    "op11_spelling": _SPELLING,
    "op13_sharding": _SHARDING,
}
