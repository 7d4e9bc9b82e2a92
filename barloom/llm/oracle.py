"""DuckDB SQL for the queries that SQL can express."""

def _sharding(shards: int = 24, axes: int = 4, bits: int = 4) -> str:
    """Shards along the Hilbert curve; the curve's bit steps are spelled out as nested selects."""
    names = [f"x{i}" for i in range(axes)]
    steps = "cells"
    for bit in range(bits - 1, 0, -1):
        q, low = 1 << bit, (1 << bit) - 1
        for name in names:
            swap = f"(xor(x0, {name}) & {low})"
            new = {"x0": f"CASE WHEN {name} & {q} <> 0 THEN xor(x0, {low}) ELSE xor(x0, {swap}) END"}
            if name != "x0":
                new[name] = f"CASE WHEN {name} & {q} <> 0 THEN {name} ELSE xor({name}, {swap}) END"
            replaced = ", ".join(f"{e} AS {n}" for n, e in new.items())
            steps = f"(SELECT * REPLACE ({replaced}) FROM {steps})"
    gray = ["x0"]
    for name in names[1:]:
        gray.append(f"xor({gray[-1]}, {name})")
    turn = "0"
    for bit in range(bits - 1, 0, -1):
        turn = f"xor({turn}, CASE WHEN g{axes - 1} & {1 << bit} <> 0 THEN {(1 << bit) - 1} ELSE 0 END)"
    place = " + ".join(f"(((xor(g{i}, turn) >> {b}) & 1) << {b * axes + axes - 1 - i})"
                       for i in range(axes) for b in range(bits))

    def number(column, skip):
        return f"CAST('0x' || rpad(substr(hex(encode({column})), 2 * {skip} + 1, 12), 12, '0') AS HUGEINT)"

    def shared(low, high):
        a, b = f"hex(encode({low}))", f"hex(encode({high}))"
        return f"len(list_filter(range(1, least(len({a}), len({b})) // 2 + 1), lambda i: {a}[1:2 * i] = {b}[1:2 * i]))"

    def scaled(value, low, high):
        return f"CAST(coalesce(({value} - {low}) * {1 << bits} // ({high} - {low} + 1), 0) AS BIGINT)"

    text = {c: scaled(number(c, f"{c}_skip"), number(f"{c}_low", f"{c}_skip"), number(f"{c}_high", f"{c}_skip"))
            for c in ("lang", "source")}
    return f"""
WITH RECURSIVE crc_steps AS (
  SELECT i AS n, CAST(i AS UBIGINT) AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS UBIGINT)) ELSE c // 2 END, k + 1
  FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY n) AS t FROM crc_steps WHERE k = 8),
rows AS (
  SELECT doc_id, lang, source, octet_length(encode(coalesce(text, ''))) + 8 AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                        lambda h: CAST('0x' || h AS UBIGINT)) AS b FROM documents),
slim AS (
  SELECT doc_id, lang, source, CAST(size AS BIGINT) AS size,
         CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), b),
                              lambda c, x: xor(c // 256, t[CAST(xor(c, x) % 256 AS INTEGER) + 1])),
                  CAST(4294967295 AS UBIGINT)) AS BIGINT) AS text_crc32 FROM rows, crc_table),
ends AS (
  SELECT count(*) AS n, min(doc_id) AS id_low, max(doc_id) AS id_high, min(lang) AS lang_low,
         max(lang) AS lang_high, min(source) AS source_low, max(source) AS source_high FROM slim),
bounds AS (SELECT *, {shared('lang_low', 'lang_high')} AS lang_skip,
  {shared('source_low', 'source_high')} AS source_skip FROM ends),
cells AS (
  SELECT doc_id, size, text_crc32, n, {text['lang']} AS x0, {text['source']} AS x1,
         CAST(least(floor(log2(greatest(size, 1))), {(1 << bits) - 1}) AS BIGINT) AS x2,
         {scaled('CAST(doc_id AS HUGEINT)', 'id_low', 'id_high')} AS x3 FROM slim, bounds),
grays AS (SELECT doc_id, size, text_crc32, n, {', '.join(f'{g} AS g{i}' for i, g in enumerate(gray))} FROM {steps}),
curve AS (SELECT doc_id, size, text_crc32, n, {place} AS hilbert FROM (SELECT *, {turn} AS turn FROM grays)),
ranked AS (SELECT *, row_number() OVER (ORDER BY hilbert, doc_id, size, text_crc32) - 1 AS place FROM curve),
dealt AS (SELECT *, place * {shards} // n AS shard FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(place - (shard * n + {shards - 1}) // {shards} AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard, CAST(hilbert AS BIGINT) AS hilbert FROM dealt
"""


OP4_URL_FILTER = r"""
WITH parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM parts),
hosts AS (SELECT DISTINCT host FROM ruled WHERE rule IN ('net/', 'example.com/de/'))
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN host IN (SELECT host FROM hosts) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

OP3_LINE_DEDUP = r"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(range(len(l))) AS line, unnest(l) AS content FROM docs WHERE doc_id IS NOT NULL),
words AS (
  SELECT DISTINCT doc_id, line, word FROM (
    SELECT doc_id, line, unnest(regexp_split_to_array(content, '[\x20\x09\x0B-\x0D]+')) AS word FROM lines)
  WHERE word <> ''),
counts AS (SELECT word, count(*) AS f FROM words GROUP BY word),
ranked AS (
  SELECT doc_id, line, word, row_number() OVER (PARTITION BY doc_id, line ORDER BY f, word) AS place,
         count(*) OVER (PARTITION BY doc_id, line) AS n
  FROM words JOIN counts USING (word)),
sets AS (SELECT doc_id, line, list(word) AS ws, max(n) AS n FROM ranked GROUP BY ALL),
prefixes AS (SELECT doc_id, line, word, n FROM ranked WHERE place <= n - (4 * n + 4) // 5 + 1),
pairs AS (
  SELECT DISTINCT y.doc_id, y.line, x.doc_id AS doc_x, x.line AS line_x
  FROM prefixes y JOIN prefixes x USING (word)
  WHERE (x.doc_id < y.doc_id OR x.doc_id = y.doc_id AND x.line < y.line)
    AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)),
gone AS (
  SELECT DISTINCT p.doc_id, p.line
  FROM pairs p JOIN sets y ON y.doc_id = p.doc_id AND y.line = p.line
  JOIN sets x ON x.doc_id = p.doc_x AND x.line = p.line_x
  WHERE 5 * len(list_intersect(x.ws, y.ws)) >= 4 * (x.n + y.n - len(list_intersect(x.ws, y.ws)))),
removed AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS removed
  FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(d.n_lines AS BIGINT) AS n_lines, coalesce(r.n, 0) AS n_removed, coalesce(r.removed, '') AS removed
FROM (SELECT doc_id, max(len(l)) AS n_lines FROM docs GROUP BY doc_id) d LEFT JOIN removed r USING (doc_id)
"""

OP7_SUFFIX_DEDUP = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS rank,
         encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS (SELECT r, rank, unnest(range(n - 49)) AS p, b FROM docs WHERE n >= 50),
strings AS (SELECT r, rank, p, array_slice(b, p + 1, p + 50) AS s FROM windows),
least AS (SELECT s, min(rank) AS low FROM strings GROUP BY s),
starts AS (SELECT r, p FROM strings JOIN least USING (s) WHERE low < rank),
marked AS (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 50 THEN 0 ELSE 1 END AS new FROM starts),
runs AS (SELECT r, a, z, row_number() OVER (PARTITION BY r ORDER BY a) AS i FROM (
  SELECT r, min(p) AS a, max(p) + 50 AS z FROM (
    SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS run FROM marked) GROUP BY r, run)),
kept AS (
  SELECT r, a AS z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS a FROM runs
  UNION ALL SELECT r, n AS z, coalesce(max(runs.z), 0) AS a FROM docs LEFT JOIN runs USING (r) GROUP BY r, n),
texts AS (SELECT r, string_agg(hex(array_slice(b, kept.a + 1, kept.z)), '' ORDER BY kept.a) AS h
  FROM kept JOIN docs USING (r) WHERE kept.z > kept.a GROUP BY r),
sums AS (SELECT r, CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(h, ''))) AS kept_sha256
FROM docs LEFT JOIN sums USING (r) LEFT JOIN texts USING (r)
"""

OP8_QUALITY = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
split AS (SELECT r, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM docs),
shapes AS (
  SELECT r, unnest(['lower', 'upper', 'digit', 'space', 'symbol', 'letter', 'control', 'mark']) AS kind,
         unnest([n_lower, n_upper, n_digit, n_space, n_symbol, n_letter, n_control,
                 length(t) - n_lower - n_upper - n_digit - n_space - n_symbol - n_letter - n_control]) AS n
  FROM (SELECT r, t,
    length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
    length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digit,
    length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')) AS n_space,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbol,
    length(regexp_replace(t, '[\x00-\x7F]', '', 'g')) AS n_letter,
    length(regexp_replace(t, '[^\x00-\x08\x0E-\x1F\x7F]', '', 'g')) AS n_control FROM docs)),
words AS (SELECT r, lang, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM split),
sizes AS (SELECT r, len(ws) AS n_words, len(t) AS n_chars FROM split),
plain AS (
  SELECT r, coalesce(sum(n) FILTER (kind <> 'space'), 0) AS visible,
         coalesce(sum(n) FILTER (kind IN ('lower', 'upper', 'letter', 'mark')), 0) AS letters
  FROM shapes GROUP BY r),
firsts AS (SELECT lang, min(r) AS r FROM docs WHERE lang <> '' GROUP BY lang, t),
languages AS (
  SELECT lang, sum(n_words) AS total FROM firsts JOIN sizes USING (r) JOIN plain USING (r) GROUP BY lang
  HAVING count(*) FILTER (n_words > 0) >= 30 AND sum(n_words) >= 1000 AND 100 * sum(letters) >= 75 * sum(visible)),
common AS (
  SELECT lang, word, n / total AS q
  FROM (SELECT w.lang, word, count(*) AS n FROM words w JOIN firsts f USING (r) GROUP BY ALL)
  JOIN languages USING (lang) WHERE n >= 0.005 * total),
shape_refs AS (
  SELECT lang, kind, n / sum(n) OVER (PARTITION BY lang) AS q
  FROM (SELECT lang, kind, sum(n) AS n FROM shapes JOIN firsts USING (r) JOIN languages USING (lang) GROUP BY ALL)),
own_shapes AS (
  SELECT r, lang, kind, n / nullif(sum(n) OVER (PARTITION BY r), 0) AS p FROM shapes JOIN docs USING (r)),
far_shapes AS (
  SELECT r, sqrt(greatest(sum(
    CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 * p END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 * p END) / 2, 0)) AS char_distance
  FROM own_shapes JOIN shape_refs USING (lang, kind) GROUP BY r),
hits AS (
  SELECT w.r, c.word, c.q, count(*) AS n FROM words w JOIN common c USING (lang, word) GROUP BY ALL),
found AS (
  SELECT r, sum(n) AS n, sum(q) AS q,
         sum(n / n_words * log2(n / n_words / ((n / n_words + q) / 2)) + q * log2(q / ((n / n_words + q) / 2))) AS s
  FROM hits JOIN sizes USING (r) GROUP BY ALL),
rest AS (SELECT lang, sum(q) AS listed FROM common GROUP BY lang),
far_words AS (
  SELECT r, CASE WHEN n_words = 0 THEN 1 ELSE sqrt(greatest((s + missing
    + CASE WHEN p > 0 THEN p * log2(p / ((p + o) / 2)) ELSE 0 END
    + CASE WHEN o > 0 THEN o * log2(o / ((p + o) / 2)) ELSE 0 END) / 2, 0)) END AS word_distance
  FROM (SELECT z.r, n_words, coalesce(f.s, 0) AS s, coalesce(listed, 0) - coalesce(f.q, 0) AS missing,
               1 - coalesce(f.n, 0) / nullif(n_words, 0) AS p, 1 - coalesce(listed, 0) AS o
        FROM sizes z JOIN docs USING (r) JOIN languages USING (lang) LEFT JOIN rest USING (lang)
        LEFT JOIN found f ON f.r = z.r)),
windows AS (
  SELECT r, i, array_to_string(list_slice(ws, i + 1, i + 5), ' ') AS w
  FROM (SELECT r, ws, unnest(range(len(ws) - 4)) AS i FROM split WHERE len(ws) >= 5)),
repeats AS (
  SELECT r, count(DISTINCT k) AS n_repeat_words FROM (
    SELECT r, unnest(range(i, i + 5)) AS k
    FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS times FROM windows) WHERE times > 1) GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
counts AS (
  SELECT doc_id, CAST(n_words AS BIGINT) AS n_words,
         CAST(n_chars - (SELECT n FROM shapes s WHERE s.r = d.r AND kind = 'space') AS BIGINT) AS word_chars,
         CAST((SELECT n FROM shapes s WHERE s.r = d.r AND kind = 'symbol') AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         n_chars, letters, visible, total IS NULL AS bare, char_distance, word_distance
  FROM docs d JOIN sizes USING (r) JOIN plain USING (r) LEFT JOIN languages USING (lang) LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)
  LEFT JOIN far_shapes USING (r) LEFT JOIN far_words USING (r)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
  AND NOT (n_chars >= 200 AND coalesce(char_distance, 0) > 0.12 + 3.2 / sqrt(n_chars))
  AND NOT (n_words >= 50 AND coalesce(word_distance, 0) > 0.12 + 1.6 / sqrt(n_words))
  AND NOT (bare AND n_chars >= 200 AND 100 * letters < 75 * visible) AS kept
FROM failed
"""

OP11_SOURCE_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
groups AS (SELECT DISTINCT lang, source FROM docs),
occurrences AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM occurrences GROUP BY ALL HAVING count(DISTINCT r) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM occurrences JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
shares AS (
  SELECT *, 1 + CAST(1000000000 AS HUGEINT) * (n + 2)
    // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p
  FROM cells),
wholes AS (
  SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 2)
    // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL)),
gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source),
terms AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM shares JOIN wholes USING (lang, term) WHERE n > 0 AND p > q),
found AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
          UNION ALL SELECT lang, source, 'term' AS part, item, value FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 10
"""

OP12_MERKLE = r"""
WITH RECURSIVE crc_steps AS (
  SELECT i AS n, CAST(i AS UBIGINT) AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS UBIGINT)) ELSE c // 2 END, k + 1
  FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY n) AS t FROM crc_steps WHERE k = 8),
digits AS (
  SELECT doc_id, xor(list_reduce(
      list_prepend(CAST(4294967295 AS UBIGINT),
                   list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS UBIGINT))),
      lambda c, x: xor(c // 256, t[CAST(xor(c, x) % 256 AS INTEGER) + 1])),
    CAST(4294967295 AS UBIGINT)) AS crc FROM documents, crc_table),
fields AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree,
         list_transform([CAST(doc_id AS VARCHAR), source, lang], lambda v:
           coalesce(octet_length(encode(v)) || ':' || v, '-')) AS before,
         CAST(n_chars AS VARCHAR) AS n,
         CAST(CASE WHEN crc % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS VARCHAR) AS changed,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS last
  FROM documents JOIN digits USING (doc_id)),
leaves AS (
  SELECT doc_id, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS idx,
         sha256(array_to_string(before, '') || coalesce(octet_length(encode(n)) || ':' || n, '-') || last) AS leaf,
         sha256(array_to_string(before, '') || coalesce(octet_length(encode(changed)) || ':' || changed, '-') || last)
           AS claimed
  FROM fields),
levels AS (
  SELECT tree, 0 AS level, list(leaf ORDER BY idx) AS nodes FROM leaves GROUP BY tree
  UNION ALL
  SELECT tree, level + 1, list_transform(range(0, len(nodes), 2),
           lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM levels WHERE len(nodes) > 1),
subroots AS (
  SELECT tree, nodes[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM levels WHERE len(nodes) = 1),
uppers AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 2),
           lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM uppers WHERE len(nodes) > 1),
nodes AS (
  SELECT tree, level, unnest(nodes) AS digest, unnest(range(len(nodes))) AS idx FROM levels WHERE len(nodes) > 1),
tops AS (SELECT level, unnest(nodes) AS digest, unnest(range(len(nodes))) AS idx FROM uppers WHERE len(nodes) > 1),
steps AS (
  SELECT doc_id, own.level, own.idx % 2 AS slot, n.digest
  FROM (SELECT doc_id, tree, level, idx >> level AS idx
        FROM leaves JOIN (SELECT DISTINCT tree, level FROM nodes) USING (tree)) own
  LEFT JOIN nodes n ON n.tree = own.tree AND n.level = own.level AND n.idx = xor(own.idx, 1)
  UNION ALL
  SELECT doc_id, 1000 + own.level, own.idx % 2, n.digest
  FROM (SELECT doc_id, level, place >> level AS idx
        FROM leaves JOIN subroots USING (tree), (SELECT DISTINCT level FROM tops)) own
  LEFT JOIN tops n ON n.level = own.level AND n.idx = xor(own.idx, 1)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY level) AS k FROM steps),
proofs AS (
  SELECT doc_id, sha256(coalesce(string_agg(digest, '' ORDER BY k), '')) AS proof_sha256 FROM numbered GROUP BY doc_id),
folded AS (
  SELECT doc_id, 0 AS k, claimed AS digest FROM leaves
  UNION ALL
  SELECT f.doc_id, n.k, sha256(CASE WHEN n.slot = 1 THEN n.digest || f.digest
                                    ELSE f.digest || coalesce(n.digest, '') END)
  FROM folded f JOIN numbered n ON n.doc_id = f.doc_id AND n.k = f.k + 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM leaves JOIN subroots USING (tree) LEFT JOIN proofs USING (doc_id)
JOIN (SELECT doc_id, arg_max(digest, k) AS folded_root FROM folded GROUP BY doc_id) USING (doc_id),
     (SELECT nodes[1] AS root FROM uppers WHERE len(nodes) = 1)
"""

ORACLE = {
    "op1_sharding": _sharding(),
    "op3_line_dedup": OP3_LINE_DEDUP,
    "op4_url_filter": OP4_URL_FILTER,
    "op7_suffix_dedup": OP7_SUFFIX_DEDUP,
    "op8_quality": OP8_QUALITY,
    "op11_source_divergence": OP11_SOURCE_DIVERGENCE,
    "op12_merkle": OP12_MERKLE,
}
