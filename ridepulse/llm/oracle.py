"""DuckDB SQL for the corpus queries that SQL can express.

Written from the definitions, by plainer means than the operators use: window
strings are grouped outright, codes compared with all codes, rules tried one
by one. The fixed values (rules, sentences, weights) are those of the
operators.

Without SQL, and held against brute force in ``tests/llm`` instead: op1
(DuckDB has no XXH64), op4 (tokenizer), op6 (trained models), op10
(approximate matching), op13 (positions of matches) and the pipeline.
"""

from __future__ import annotations

from ridepulse.llm import licenses, mixing, rlz_dedup, spelling, suffix_dedup
from ridepulse.llm.common import WORD

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("'", "''") + "'"


# crc32 by its definition: a table of 256 entries (``crc_table``, one row), then byte by byte.
_CRC_TABLE = """crc_table AS (
  SELECT list(t ORDER BY n) AS crc FROM (
    SELECT n, list_reduce(list_concat([n], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))) AS t FROM range(256) r(n)
  )
)"""


def _crc32(value: str) -> str:
    """crc32 of a string's UTF-8 bytes, as BIGINT; needs ``crc`` of ``crc_table``."""
    utf8 = f"hex(encode({value}))"
    at = f"list_transform(range(octet_length(encode({value}))::BIGINT), lambda i: ('0x' || {utf8}[2 * i + 1 : 2 * i + 2])::BIGINT)"
    step = "lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {at}), {step}), 4294967295)"


def urls(rules: list[tuple[str, str, str]], labels: list[str]) -> str:
    values = ", ".join(f"({text(h)}, {text(p)}, {text(v)})" for h, p, v in rules)
    listed = ", ".join(map(text, labels))
    return f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {values}),
parts AS (
  SELECT page_id, row_number() OVER () AS n,
         coalesce({_LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
judged AS (SELECT *, regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '') AS canonical FROM parts),
listed AS (
  SELECT DISTINCT canonical FROM judged
  WHERE list_has_any(string_split(host, '.'), [{listed}]) AND canonical <> ''
),
best AS (
  SELECT n, arg_max({{'rule': rule_host || rule_path, 'verdict': rule_verdict}},
                    length(rule_host || rule_path) * 10000 + length(rule_host)) AS b
  FROM judged JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n
)
SELECT page_id, host, path, b.rule AS rule,
       coalesce(b.verdict, CASE WHEN host <> '' AND canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN best USING (n)"""


def license_scan() -> str:
    known = ", ".join(f"({text(s)}, {text(i)})" for s, i in licenses.SENTENCES.items())
    ends = "string_split(regexp_replace({}, '([.!?])[ \\t\\r\\f]+', '\\1' || chr(10), 'g'), chr(10))"
    flow = (
        "regexp_replace(regexp_replace(t, '\\n[ \\t\\r\\f]*\\n', '.' || chr(10) || chr(10), 'g'),"
        " '([^\\n])\\n([^\\n])', '\\1 \\2', 'g')"
    )
    step, tried = "runs", []
    for n, (name, ids) in enumerate(licenses.RULES):
        run = text("".join(f",{i}," for i in ids))
        tried.append(
            f"s{n} AS (SELECT n, reading, seq, CASE WHEN contains(rest, {run}) THEN list_append(found, {text(name)})"
            f" ELSE found END AS found, replace(rest, {run}, '') AS rest FROM {step})"
        )
        step = f"s{n}"
    order = "[" + ", ".join(text(x) for x in dict.fromkeys(name for name, _ in licenses.RULES)) + "]"
    trim = "trim(replace({}, ',,', ','), ',')"
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
docs AS (
  SELECT doc_id, row_number() OVER () AS n,
         CASE WHEN regexp_matches(text, {text(licenses.TRIGGER)}) THEN text ELSE '' END AS t
  FROM documents
),
readings AS (
  SELECT n, 1 AS reading, {ends.format("t")} AS sentences FROM docs
  UNION ALL SELECT n, 2, {ends.format(flow)} FROM docs
),
split AS (SELECT n, reading, unnest(sentences) AS s, generate_subscripts(sentences, 1) AS pos FROM readings),
words AS (SELECT n, reading, pos, trim(regexp_replace(lower(s), '[^a-z0-9.+-]+', ' ', 'g')) AS s FROM split),
normal AS (SELECT n, reading, pos, trim(regexp_replace(s, '[.]+$|[.]+( )', '\\1', 'g')) AS s FROM words),
hits AS (
  SELECT n, reading, string_agg(',' || id || ',', '' ORDER BY pos) AS seq
  FROM normal JOIN known ON s = sentence GROUP BY n, reading
),
runs AS (
  SELECT n, reading, coalesce(seq, '') AS seq, CAST([] AS VARCHAR[]) AS found, coalesce(seq, '') AS rest
  FROM readings LEFT JOIN hits USING (n, reading)
),
{", ".join(tried)}
SELECT doc_id,
       concat_ws('|', {trim.format("a.seq")}, {trim.format("b.seq")}) AS sentences,
       array_to_string(list_filter({order}, lambda x: list_contains(a.found, x) OR list_contains(b.found, x)), ',') AS licenses,
       {trim.format("a.rest")} AS unmatched
FROM docs JOIN {step} a ON a.n = docs.n AND a.reading = 1 JOIN {step} b ON b.n = docs.n AND b.reading = 2"""


def byte_repeats(width: int = suffix_dedup.WIDTH, piece: int = 1000) -> str:
    """Every window of ``width`` bytes, as hexadecimal, is grouped with its equals. Texts are cut in
    overlapping pieces only because taking a part of a long string is slow."""
    return f"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (
  SELECT doc_id, base, substr(h, 2 * base + 1, {2 * (piece + width - 1)}) AS part
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2, {piece})) AS base FROM docs)
),
bytes AS (
  SELECT doc_id, base + i AS pos, substr(part, 2 * i + 1, 2) AS b, substr(part, 2 * i + 1, {2 * width}) AS w
  FROM (SELECT doc_id, base, part, unnest(range(0, least({piece}, length(part) // 2))) AS i FROM pieces)
),
judged AS (
  SELECT doc_id, pos, b, length(w) = {2 * width} AND min(doc_id) OVER (PARTITION BY w) < doc_id AS repeated FROM bytes
),
marked AS (
  SELECT doc_id, pos, b, bool_or(repeated) OVER (PARTITION BY doc_id ORDER BY pos
                                 ROWS BETWEEN {width - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM judged
),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS first FROM marked),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (first) AS n_spans,
         coalesce(string_agg(b, '' ORDER BY pos) FILTER (NOT gone), '') AS rest
  FROM runs GROUP BY doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(from_hex(coalesce(rest, ''))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""


def word_repeats(width: int = rlz_dedup.WIDTH) -> str:
    """Every window of ``width`` words is grouped with its equals."""
    return f"""
WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, {text(WORD)}), []) AS words FROM documents),
places AS (
  SELECT doc_id, pos, words[pos] AS word,
         CASE WHEN pos + {width - 1} <= len(words) THEN array_to_string(words[pos:pos + {width - 1}], ' ') END AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos FROM docs)
),
judged AS (SELECT doc_id, pos, word, w IS NOT NULL AND count(*) OVER (PARTITION BY w) > 1 AS repeated FROM places),
marked AS (
  SELECT doc_id, pos, word, bool_or(repeated) OVER (PARTITION BY doc_id ORDER BY pos
                                    ROWS BETWEEN {width - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM judged
),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS rest
  FROM marked GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""


def mix(block_words: int = mixing.BLOCK_WORDS) -> str:
    weights = "[" + ", ".join(map(str, mixing.WEIGHTS)) + "]"
    return f"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {text(WORD)})), 0) AS size FROM documents
),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s
  FROM sizes GROUP BY source
),
weighed AS (
  SELECT *, {weights}[s % {len(mixing.WEIGHTS)} + 1] AS weight, {mixing.MAX_EPOCHS} * source_size AS cap FROM per
),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) - CAST(coalesce(sum(cap) OVER (ORDER BY cap / weight, s
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
            / CAST(sum(weight) OVER (ORDER BY cap / weight, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
  FROM weighed
),
aimed AS (
  SELECT *, CASE WHEN level * weight >= cap THEN CAST(cap AS DOUBLE)
                 ELSE weight * (SELECT arg_min(level, (cap / weight, s)) FROM levels WHERE level * weight < cap) END AS target
  FROM levels
),
plan AS (
  SELECT *, CAST(ceil(source_size / {block_words}) AS BIGINT) AS blocks,
         CASE WHEN source_size > 0 THEN target * CAST(ceil(source_size / {block_words}) AS BIGINT) / source_size ELSE 0 END AS slots
  FROM aimed
),
edges AS (
  SELECT s, blocks, CAST(floor(sum(slots) OVER (ORDER BY s) / sum(slots) OVER () * {mixing._MOD}) AS BIGINT) AS upto
  FROM plan WHERE slots > 0
),
shares AS (SELECT *, coalesce(lag(upto) OVER (ORDER BY s), 0) AS since FROM edges),
slot AS (
  SELECT i, (i % {mixing._MOD}) * {mixing._STEP} % {mixing._MOD} AS u
  FROM (SELECT unnest(range(CAST(ceil(sum(slots)) AS BIGINT))) AS i FROM plan)
),
ranked AS (
  SELECT s, blocks, row_number() OVER (PARTITION BY s ORDER BY i) - 1 AS r
  FROM slot JOIN shares ON u >= since AND u < upto
),
times AS (SELECT s, r % blocks AS block, count(*) AS n FROM ranked WHERE r // blocks < {mixing.MAX_EPOCHS} GROUP BY ALL),
placed AS (
  SELECT doc_id, s, size, source_size, blocks,
         CAST(sum(size) OVER (PARTITION BY s ORDER BY md5('mix' || doc_id), doc_id) AS BIGINT) AS upto
  FROM sizes JOIN plan ON sizes.source IS NOT DISTINCT FROM plan.source WHERE size > 0
),
pieces AS (
  SELECT *, upto - size AS since,
         unnest(range((upto - size) * blocks // source_size, least(upto * blocks // source_size, blocks - 1) + 1)) AS block
  FROM placed
),
taken AS (
  SELECT doc_id, CAST(sum(n * greatest(0, least(upto, (block + 1) * source_size // blocks)
                                          - greatest(since, block * source_size // blocks))) AS BIGINT) AS taken
  FROM pieces JOIN times USING (s, block) GROUP BY doc_id
)
SELECT sizes.doc_id, size, source_size, target, coalesce(taken, 0) AS taken, sizes.source
FROM sizes JOIN plan ON sizes.source IS NOT DISTINCT FROM plan.source LEFT JOIN taken ON taken.doc_id = sizes.doc_id"""


def top_k(k: int) -> str:
    return f"""
WITH codes AS (
  SELECT DISTINCT vec_id,
         list_sum(list_transform(range(64), lambda i: CASE WHEN embedding[i + 1] > 0 THEN 1::HUGEINT << i::INTEGER ELSE 0::HUGEINT END))::HUGEINT AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
),
pairs AS (
  SELECT q.vec_id, q.code, d.vec_id AS neighbor_id, CAST(bit_count(xor(q.code, d.code)) AS INTEGER) AS distance
  FROM codes q JOIN codes d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0
)
SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id, code ORDER BY distance, neighbor_id) AS INTEGER) AS rank, neighbor_id, distance
FROM pairs QUALIFY rank <= {k}"""


def variants(slip: int) -> str:
    """Near words by equal deletions."""
    run = f"regexp_extract_all(text, {text('[A-Z' + spelling.LETTERS + ']+')})"
    return f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, unnest({run}) AS run FROM documents),
per AS (
  SELECT doc_id, {_LOWER.format("run")} AS run, count(*) AS n FROM runs WHERE length(run) >= {spelling.MIN_CHARS} GROUP BY ALL
),
hashed AS (SELECT run, n, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM per, crc_table),
slipped AS (
  SELECT CASE WHEN h % {slip} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= {spelling.MIN_CHARS}
  GROUP BY word HAVING sum(n) >= {spelling.MIN_COUNT}
),
cuts AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS cut FROM words, unnest(range(1, length(word) + 1)) t(i)),
near AS (
  SELECT a.word, b.word AS near FROM cuts a JOIN cuts b USING (i, cut) WHERE a.word <> b.word
  UNION SELECT a.word, a.cut FROM cuts a JOIN words w ON w.word = a.cut
  UNION SELECT a.cut, a.word FROM cuts a JOIN words w ON w.word = a.cut
),
best AS (
  SELECT near.word, count(*) OVER (PARTITION BY near.word) AS n_near, near AS best, w.n AS best_n,
         row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, near) AS r
  FROM near JOIN words w ON w.word = near.near
),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best_n >= {spelling.FORM_RATIO} * n THEN best END AS form,
         CASE WHEN best_n >= {spelling.FORM_RATIO} * n THEN best_n END AS form_n
  FROM words LEFT JOIN (SELECT * FROM best WHERE r = 1) USING (word)
),
chain AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT chain.word, formed.word, formed.form FROM chain JOIN formed ON formed.word = chain.next
)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN (SELECT word, root FROM chain WHERE next IS NULL) USING (word)"""


def trie(group: int, most: int) -> str:
    """Nodes as lists of turns; what a subtree holds by way of each node's smallest member."""
    return f"""
WITH {_CRC_TABLE},
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
),
hashed AS (SELECT conv_id, turn, role, text, sha256(length(role) || ':' || role || text) AS id FROM turns),
own AS (SELECT conv_id, id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, id) AS k FROM hashed),
convs AS (
  SELECT conv_id, conv_id - conv_id % {group} AS base, {_crc32("conv_id::VARCHAR")} % {most + 1} AS h
  FROM (SELECT DISTINCT conv_id FROM own), crc_table
),
turned AS (
  SELECT convs.conv_id, 0 AS part, k, id, text FROM convs JOIN own ON own.conv_id = base AND k <= h
  UNION ALL SELECT conv_id, 1, k, id, text FROM own JOIN convs USING (conv_id) WHERE k > h
),
placed AS (
  SELECT conv_id, row_number() OVER w AS depth, list(id) OVER (w ROWS UNBOUNDED PRECEDING) AS path,
         coalesce(len(regexp_extract_all(text, {text(WORD)})), 0) AS words
  FROM turned WINDOW w AS (PARTITION BY conv_id ORDER BY part, k)
),
members AS (
  SELECT conv_id, 0 AS depth, []::VARCHAR[] AS path, 0 AS words FROM convs UNION ALL SELECT conv_id, depth, path, words FROM placed
),
lengths AS (SELECT conv_id, max(depth) AS len FROM members GROUP BY conv_id),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS value,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len), '') AS ends
  FROM members JOIN lengths USING (conv_id) GROUP BY path, depth
),
children AS (SELECT path[1 : depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
bearing AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
sums AS (
  SELECT m.path, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(b.value) AS saved
  FROM bearing b JOIN members m ON m.conv_id = b.conv_id AND m.depth <= b.depth GROUP BY m.path
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM bearing n JOIN sums s USING (path) LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1 : n.depth - 1]"""
