"""DuckDB SQL that gives the rows of the queries, where SQL can express them."""

from __future__ import annotations

from readloom.llm import licenses, mixing, quality, sharding

OP7 = f"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) t),
sized AS (
  SELECT doc_id, coalesce(strlen(text), 0) + {sharding.OVERHEAD} size, coalesce(md5(text), '') digest,
         coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295), 0) text_crc32
  FROM documents, crc_table),
placed AS (
  SELECT *, sum(size) OVER o - size byte_at, sum(size) OVER () total, row_number() OVER o r
  FROM sized WINDOW o AS (ORDER BY digest, doc_id ROWS UNBOUNDED PRECEDING)),
cut AS (SELECT *, CAST(byte_at * {sharding.SHARDS} // total AS INTEGER) shard FROM placed)
SELECT doc_id, CAST(size AS BIGINT) size, CAST(text_crc32 AS BIGINT) text_crc32, 'bytes' law, shard,
       CAST(r - min(r) OVER (PARTITION BY shard) AS BIGINT) slot, CAST(NULL AS INTEGER) grown_shard
FROM cut
"""

OP9 = """
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END rest FROM pages),
u AS (
  SELECT row_number() OVER () row_no, page_id, lower(regexp_extract(rest, '^([^/?#]*)', 1)) host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path FROM p),
best AS (
  SELECT row_no, r.host || r.path rule, verdict, row_number() OVER (
           PARTITION BY row_no ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) n
  FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') verdict
FROM u LEFT JOIN (SELECT * FROM best WHERE n = 1) USING (row_no)
"""


def _fences(source: str, keys: str) -> str:
    by = f"{keys}, measure" if keys else "measure"

    def at(share: int) -> str:
        return f"min(bin) FILTER (upto * 100 >= total * {share})"

    def width(v: str) -> str:
        return f"(CAST(1 AS BIGINT) << greatest(length(bin({v})) - {quality.BITS}, 0))"

    return f"""
  SELECT {by}, n, greatest(CASE WHEN q1 = q3 THEN lowest - {width("lowest")} ELSE q1 - {quality.RANGES} * (q3 - q1) END, 0) low,
         CASE WHEN q1 = q3 THEN highest + {width("highest")} ELSE q3 + {quality.RANGES} * (q3 - q1) END high
  FROM (SELECT {by}, max(total) n, {at(100 - quality.TAIL)} lowest, {at(25)} q1, {at(75)} q3, {at(quality.TAIL)} highest
        FROM (SELECT {by}, bin, sum(count(*)) OVER (PARTITION BY {by}) total,
                     sum(count(*)) OVER (PARTITION BY {by} ORDER BY bin) upto
              FROM {source} GROUP BY {by}, bin) GROUP BY {by})"""


def _shrunk(own: str, coarser: str) -> str:
    k = quality.PRIOR
    return (f"({own}.n * {own}.low + {k} * {coarser}.low) // ({own}.n + {k}) low, "
            f"({own}.n * {own}.high + {k} * {coarser}.high + {own}.n + {k} - 1) // ({own}.n + {k}) high")


OP10 = f"""
WITH d AS (
  SELECT row_number() OVER () row_no, doc_id, lang, source, coalesce(text, '') t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w FROM documents),
win AS (
  SELECT row_no, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] s
  FROM (SELECT row_no, w, unnest(range(1, len(w) - 1)) i FROM d)),
covered AS (
  SELECT row_no, count(DISTINCT i + k) n FROM (
    SELECT row_no, i FROM (SELECT *, count(*) OVER (PARTITION BY row_no, s) c FROM win) WHERE c > 1),
    (SELECT unnest(range(3)) k) GROUP BY row_no),
m AS (
  SELECT d.*, len(w) n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) word_chars,
         length(t) - length(translate(t, '{quality.SYMBOLS}', '')) n_symbols,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))) n_lines,
         len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) n_kinds,
         coalesce(covered.n, 0) n_repeat_words
  FROM d LEFT JOIN covered USING (row_no)),
rate AS (
  SELECT *, coalesce(1000 * n_symbols // nullif(word_chars, 0), 0) symbols,
         coalesce(1000 * (n_lines - n_kinds) // nullif(n_lines, 0), 0) dup_lines,
         coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) repeats,
         coalesce(100 * word_chars // nullif(n_words, 0), 0) word_length FROM m),
long AS (
  SELECT row_no, lang, source, measure, CAST(v AS BIGINT) v,
         (CAST(v AS BIGINT) >> greatest(length(bin(CAST(v AS BIGINT))) - {quality.BITS}, 0))
           << greatest(length(bin(CAST(v AS BIGINT))) - {quality.BITS}, 0) bin
  FROM (SELECT row_no, lang, source, n_words, unnest(['symbols', 'dup_lines', 'repeats', 'word_length']) measure,
               unnest([symbols, dup_lines, repeats, word_length]) v FROM rate) WHERE n_words > 0),
own AS ({_fences("long", "lang, source")}),
of_lang AS ({_fences("long", "lang")}),
every AS ({_fences("long", "")}),
by_lang AS (SELECT o.lang, measure, {_shrunk("o", "e")} FROM of_lang o JOIN every e USING (measure)),
fence AS (
  SELECT o.lang, o.source, o.measure, {_shrunk("o", "l")} FROM own o
  JOIN by_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure),
judged AS (
  SELECT row_no, bool_and(v BETWEEN low AND high) inside
  FROM long JOIN fence f ON long.lang IS NOT DISTINCT FROM f.lang AND long.source IS NOT DISTINCT FROM f.source
         AND long.measure = f.measure GROUP BY row_no),
base AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words base_failed FROM rate)
SELECT doc_id, CAST(n_words AS BIGINT) n_words, CAST(word_chars AS BIGINT) word_chars,
       CAST(n_symbols AS BIGINT) n_symbols, CAST(n_lines - n_kinds AS BIGINT) n_dup_lines,
       CAST(n_repeat_words AS BIGINT) n_repeat_words, base_failed,
       NOT base_failed AND coalesce(inside, false) kept
FROM base LEFT JOIN judged USING (row_no)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op4() -> str:
    rows = ", ".join(f"({n}, {_quoted(name)}, {licenses.width(licenses.words_of(t))}, {_quoted(t)})"
                     for n, (name, t) in enumerate(licenses.TEMPLATES))
    n = licenses.SHINGLE
    joined = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    return f"""
WITH templates(template_id, license, width, text) AS (VALUES {rows}),
tw AS (SELECT template_id, license, width, regexp_extract_all(lower(text), '[a-z0-9]+') w FROM templates),
ts AS (SELECT DISTINCT template_id, license, width, {joined} s
       FROM (SELECT *, unnest(range(1, len(w) - {n - 2})) i FROM tw)),
sizes AS (SELECT template_id, count(*) total FROM ts GROUP BY 1),
dw AS (SELECT row_number() OVER () row_no, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') w FROM documents),
ds AS (SELECT row_no, i - 1 p, {joined} s FROM (SELECT *, unnest(range(1, len(w) - {n - 2})) i FROM dw)),
hits AS (SELECT row_no, template_id, license, width, p, s FROM ds JOIN ts USING (s)),
windows AS (
  SELECT row_no, template_id, license, p // width window_no, s FROM hits
  UNION ALL SELECT row_no, template_id, license, p // width - 1, s FROM hits
  WHERE p >= width AND p % width <= width - {n}),
found AS (
  SELECT row_no, template_id, license FROM windows JOIN sizes USING (template_id)
  GROUP BY row_no, template_id, license, window_no, total HAVING count(DISTINCT s) >= {licenses.LEAST} * total)
SELECT doc_id, CAST(count(DISTINCT template_id) AS BIGINT) n_notices, CAST(count(DISTINCT license) AS BIGINT) n_licenses,
       coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') licenses
FROM dw LEFT JOIN found USING (row_no) GROUP BY row_no, doc_id
"""


OP13 = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) size,
         md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')) place FROM documents),
placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place ROWS UNBOUNDED PRECEDING) - size word_at FROM sized),
numbered AS (
  SELECT source, CAST(sum(size) AS BIGINT) n, row_number() OVER (ORDER BY source NULLS LAST) o FROM sized GROUP BY source),
weighed AS (SELECT *, [{", ".join(map(str, mixing.WEIGHTS))}][(o - 1) % {len(mixing.WEIGHTS)} + 1] w FROM numbered),
held AS (
  SELECT CAST(sum({mixing.MOST} * n) OVER p AS BIGINT) upto, sum(w) OVER p w_upto FROM weighed
  WINDOW p AS (ORDER BY {mixing.MOST} * n / w ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT 0, 0),
whole AS (SELECT CAST(sum(n) AS BIGINT) total, CAST(sum(w) AS BIGINT) w_total FROM weighed),
raised AS (SELECT max(CAST(total - upto AS DOUBLE) / CAST(w_total - w_upto AS DOUBLE)) v FROM held, whole WHERE w_upto < w_total),
targets AS (SELECT source, n, o, least(CAST({mixing.MOST} * n AS DOUBLE), w * v) target FROM weighed, raised),
block AS (
  SELECT max(b) b FROM (SELECT CAST(pow(2, unnest(range({mixing.LARGEST_BLOCK.bit_length()}))) AS BIGINT) b)
  WHERE b = 1 OR b <= (SELECT min(target) FROM targets WHERE target > 0) / {mixing.FINENESS}),
quotients AS (
  SELECT source, o, target / (2 * k - 1) q FROM (SELECT *, unnest(range(1, {mixing.MOST} * n // b + 1)) k FROM targets, block)),
given AS (
  SELECT source FROM (SELECT source, row_number() OVER (ORDER BY q DESC, o) r FROM quotients), whole, block
  WHERE r <= (2 * total + b) // (2 * b)),
quotas AS (SELECT source, count(*) blocks FROM given GROUP BY source),
every AS (SELECT t.*, coalesce(blocks, 0) blocks, b FROM targets t CROSS JOIN block LEFT JOIN quotas q ON t.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, CAST(size AS BIGINT) size, n source_size, target,
       CAST(blocks * b // greatest(n, 1) * size + least(greatest(blocks * b % greatest(n, 1) - word_at, 0), size) AS BIGINT) taken, blocks
FROM placed p JOIN every e ON p.source IS NOT DISTINCT FROM e.source
"""
