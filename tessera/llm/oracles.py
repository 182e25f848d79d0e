"""DuckDB SQL for queries whose answer SQL can state over the rows themselves: plain windows, joins and
counts, without the operators' filters, sketches, graphs or indexes."""

from __future__ import annotations

from tessera.llm import debruijn, feistel, linedrop, oddsketch, wumanber
from tessera.llm.common import LOWER, UPPER

_AZ = f"'{UPPER}', '{LOWER}'"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"
_ALNUM = "regexp_extract_all(translate(coalesce({}, ''), " + _AZ + "), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def op2_sql() -> str:
    size = wumanber.WINDOW
    return f"""
WITH item AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, w, least({size}, len(w)) AS k
              FROM (SELECT item_id, {_ALNUM.format('text')} AS w FROM benchmark) WHERE len(w) > 0),
pattern AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS p
            FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM item)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM.format('text')} AS w FROM documents),
place AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM pattern) WHERE len(w) >= k),
hit AS (SELECT r, i, k, item_id FROM (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS p FROM place)
        JOIN pattern USING (k, p)),
covered AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM hit) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""


def op3_sql() -> str:
    k = debruijn.WINDOW
    return f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
place AS (SELECT r, i, sha256(array_to_string(w[i:i + {k - 1}], ' ')) AS h
          FROM (SELECT *, unnest(range(1, len(w) - {k - 2})) AS i FROM doc WHERE len(w) >= {k})),
again AS (SELECT h FROM place GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {k})) AS j FROM place SEMI JOIN again USING (h)),
word AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM doc),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS t FROM word ANTI JOIN gone USING (r, j) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)"""


def op5_sql() -> str:
    k = oddsketch.SHINGLE
    words = _WORDS.format(f"translate(coalesce(text, ''), {_AZ})")
    return f"""
WITH RECURSIVE doc AS (SELECT doc_id, {words} AS w FROM documents),
shingle AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {k - 1}], ' ') AS s
            FROM (SELECT *, unnest(range(1, greatest(len(w) - {k - 2}, 2))) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b USING (s)
         WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
         WHERE 100 * shared.n >= {oddsketch.SIMILARITY} * (x.n + y.n - shared.n)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least_id AS (SELECT a AS doc_id, min(b) AS other FROM reach GROUP BY a)
SELECT doc_id, coalesce(size.n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id,
       doc_id <= coalesce(other, doc_id) AS kept
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN least_id USING (doc_id)"""


def op7_sql() -> str:
    return f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM doc),
keyed AS (SELECT *, translate(trim(line, {_SPACES}), {_AZ}) AS key FROM line),
often AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= {linedrop.MIN_DOCUMENTS})
SELECT doc_id, count(*) AS n_lines, count(often.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (often.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN often USING (key) GROUP BY r, doc_id"""


def op10_sql() -> str:
    def half(i: int, x: str, size: str) -> str:
        return f"('0x' || substr(md5('{feistel.SEED}:{i}:' || {x}), 1, 15))::BIGINT % {size}"

    def once(source: str) -> str:
        out = f"SELECT row_no, n, a, b, p // b AS l, p % b AS q FROM {source}"
        for i in range(feistel.ROUNDS):
            new = f"l, (q + {half(i, 'l', 'b')}) % b AS q" if i % 2 else f"(l + {half(i, 'q', 'a')}) % a AS l, q"
            out = f"SELECT row_no, n, a, b, {new} FROM ({out})"
        return f"SELECT row_no, n, a, b, l * b + q AS p FROM ({out})"

    crc = "n"
    for _ in range(8):
        crc = f"(SELECT CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM (SELECT {crc} AS c))"
    s = feistel.SHARDS
    return f"""
WITH RECURSIVE crc_table AS (SELECT list(c ORDER BY n) AS t FROM (SELECT n, {crc} AS c FROM (SELECT unnest(range(256)) AS n))),
doc AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS row_no,
               count(*) OVER () AS n FROM documents),
sized AS (SELECT row_no, row_no AS p, n, floor(sqrt(n - 1))::BIGINT + 1 AS a FROM doc),
start AS (SELECT *, (n + a - 1) // a AS b FROM sized),
walk AS ({once('start')} UNION ALL {once('(SELECT * FROM walk WHERE p >= n)')}),
bytes AS (SELECT row_no, t, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT) AS bs
          FROM doc, crc_table),
crc AS (SELECT row_no, xor(list_reduce(list_prepend(4294967295, bs), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])),
                           4294967295) AS text_crc32 FROM bytes)
SELECT doc_id, strlen(text) + 8 AS size, text_crc32, 'rows' AS law, (p % {s})::INT AS shard, p // {s} AS slot,
       NULL::INT AS grown_shard
FROM doc JOIN walk USING (row_no) JOIN crc USING (row_no) WHERE p < walk.n"""
