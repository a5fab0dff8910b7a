"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .urls import BLOCKED_WORDS

_PARTS = """
parts AS (
  SELECT page_id,
         CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), ruled AS (
  SELECT page_id, host, path,
         CASE
           WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
           WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
           WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
           WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
           WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/'
         END AS rule
  FROM split
)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

ORACLE_SQL = {
    "op6_near_duplicates": f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS k FROM doc WHERE len(w) > 0)
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingle AS x INNER JOIN shingle AS y ON x.s = y.s AND x.doc_id > y.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM common INNER JOIN size AS p ON p.doc_id = a INNER JOIN size AS q ON q.doc_id = b
  WHERE 100 * shared >= 80 * (p.n + q.n - shared)
), edge AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach INNER JOIN edge ON reach.b = edge.a
), least AS (
  SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       doc_id <= coalesce(m, doc_id) AS kept
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN least USING (doc_id)""",
    "op10_decontamination": f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark
), sized AS (
  SELECT item_id, w, least(10, len(w)) AS m FROM item WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[k:k + m - 1], ' ') AS words
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM sized)
), places AS (
  SELECT doc_id, m, k, array_to_string(w[k:k + m - 1], ' ') AS words
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k
        FROM doc CROSS JOIN (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)
), found AS (
  SELECT doc_id, item_id, m, k FROM places INNER JOIN windows USING (m, words)
), hits AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + m)) AS spot FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_url_filter": f"""
WITH {_PARTS}
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
            WHEN rule IS NULL AND regexp_matches(host, '(^|[.-])({"|".join(BLOCKED_WORDS)})([.-]|$)') THEN 'block'
            ELSE 'allow' END AS verdict
FROM ruled""",
}


# --- Merkle manifest: one pair of tables for each level of the trees --------

_ALPHABET = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_CRC_TABLE = """SELECT list_transform(range(0, 256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"""


def _crc32(text: str) -> str:
    """The crc32 of a text of ASCII and U+00C0 to U+00FF, with ``_CRC_TABLE`` at hand."""
    codes = f"""flatten(list_transform(string_split({text}, ''), lambda x: CASE WHEN unicode(x) < 128
      THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END))"""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295)"""


def _leaf(text: str) -> str:
    def part(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    return f"""sha256({part('doc_id::VARCHAR')} || {part('source')} || {part('lang')} ||
      {part('n_chars::VARCHAR')} || {part(text)})"""


def _climb(name: str, first: int, last: int) -> str:
    """Levels ``first`` to ``last``: runs of eight nodes, the nodes above, and
    each document's place, siblings and folded node so far."""
    return ", ".join(f"""
{name}r{k} AS (
  SELECT t, p // 8 AS run, any_value(c) AS c, string_agg(h, '' ORDER BY p) AS hs
  FROM (SELECT *, count(*) OVER (PARTITION BY t) AS c FROM {name}n{k}) GROUP BY t, p // 8
), {name}n{k + 1} AS (
  SELECT t, run AS p, CASE WHEN c = 1 THEN hs ELSE sha256(hs) END AS h FROM {name}r{k}
), {name}f{k + 1} AS (
  SELECT doc_id, leaf, t, grp, run AS p, CASE WHEN c = 1 THEN proof ELSE proof || lo || hi END AS proof,
         CASE WHEN c = 1 THEN g ELSE sha256(lo || g || hi) END AS g
  FROM (SELECT f.*, c, run, substr(hs, 1, 64 * (p % 8)) AS lo, substr(hs, 64 * (p % 8) + 65) AS hi
        FROM {name}f{k} AS f INNER JOIN {name}r{k} AS r ON r.t = f.t AND run = p // 8)
)""" for k in range(first, last))


# Up to 8 ** 8 documents of a language, and 8 ** 3 languages.
ORACLE_SQL["op11_merkle_manifest"] = f"""
WITH tab AS ({_CRC_TABLE}), doc AS (
  SELECT doc_id, coalesce(':' || lang, '-') AS t, {_leaf('text')} AS leaf, {_leaf(f'translate(text, {_ALPHABET})')} AS low,
         coalesce({_crc32('doc_id::VARCHAR')} % 3 = 0, false) AS changed
  FROM documents, tab
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM doc
), an0 AS (
  SELECT t, p, leaf AS h FROM placed
), af0 AS (
  SELECT doc_id, leaf, t, t AS grp, p, '' AS proof, CASE WHEN changed THEN low ELSE leaf END AS g FROM placed
), {_climb('a', 0, 8)}, sub AS (
  SELECT t AS grp, h, row_number() OVER (ORDER BY t) - 1 AS p FROM an8
), bn0 AS (
  SELECT '' AS t, p, h FROM sub
), bf0 AS (
  SELECT doc_id, leaf, '' AS t, f.grp, sub.p, proof, g FROM af8 AS f INNER JOIN sub ON sub.grp = f.grp
), {_climb('b', 0, 3)}
SELECT doc_id, leaf, sub.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256, g AS folded_root, g = root.h AS verified
FROM bf3 INNER JOIN sub ON sub.grp = bf3.grp CROSS JOIN bn3 AS root"""

ORACLE_SQL["op12_source_mixture"] = """
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(':' || source, '~') AS src,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size
  FROM documents
), src AS (
  SELECT src, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY src) - 1) % 3 AS w
  FROM doc GROUP BY src
), total AS (
  SELECT sum(size)::BIGINT AS t FROM doc
), level(l) AS (
  SELECT 0::DOUBLE
  UNION
  SELECT (any_value(t) - coalesce(sum(CASE WHEN 3 * source_size <= w * l THEN 3 * source_size END), 0))::DOUBLE
         / sum(CASE WHEN 3 * source_size > w * l THEN w END)::DOUBLE
  FROM level, src, total GROUP BY l
), queue AS (
  SELECT doc.*, source_size, w, least(3 * source_size::DOUBLE, w * (SELECT max(l) FROM level)) AS target,
         sum(size) OVER (PARTITION BY src ORDER BY md5(coalesce(doc_id::VARCHAR, '-') || ':' || size), doc_id, size, id
                         ROWS UNBOUNDED PRECEDING)::BIGINT AS words
  FROM doc INNER JOIN src USING (src)
), turn AS (
  SELECT id, size, src, words + again * source_size AS served, w
  FROM queue CROSS JOIN (SELECT unnest([0, 1, 2]) AS again) WHERE size > 0
), taken AS (
  SELECT id, count(*) AS takes
  FROM (SELECT id, sum(size) OVER (ORDER BY served::DOUBLE / w, src, served ROWS UNBOUNDED PRECEDING) AS upto FROM turn)
  WHERE upto <= (SELECT t FROM total) GROUP BY id
)
SELECT doc_id, size, source_size, target, size * coalesce(takes, 0) AS taken FROM queue LEFT JOIN taken USING (id)"""

ORACLE_SQL["op13_spelling_variants"] = f"""
WITH RECURSIVE tab AS ({_CRC_TABLE}), run AS (
  SELECT doc_id, r, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents)
  WHERE length(r) >= 5 GROUP BY ALL
), hashed AS (
  SELECT r, c, {_crc32("(coalesce(doc_id::VARCHAR, '') || ':' || r)")} AS h FROM run, tab
), typed AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, c
  FROM hashed
), words AS (
  SELECT word, sum(c)::BIGINT AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), spot AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words
), gap AS (
  SELECT word, n, k, substr(word, 1, k - 1) AS lo, substr(word, k + 1) AS hi FROM spot
), pair AS (
  SELECT x.word, y.word AS other, y.n AS m
  FROM gap AS x INNER JOIN gap AS y ON x.k = y.k AND x.lo = y.lo AND x.hi = y.hi AND x.word <> y.word
  UNION SELECT gap.word, words.word, words.n FROM gap INNER JOIN words ON words.word = lo || hi
  UNION SELECT words.word, gap.word, gap.n FROM gap INNER JOIN words ON words.word = lo || hi
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m, min(other) FILTER (m = top) AS other
  FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM pair) GROUP BY word
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form,
         CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT chain.word, formed.form FROM chain INNER JOIN formed ON formed.word = chain.at WHERE form IS NOT NULL
)
SELECT formed.word, formed.form, chain.at AS root, formed.n, formed.n_near, formed.form_n
FROM formed INNER JOIN chain ON chain.word = formed.word
INNER JOIN formed AS last ON last.word = chain.at AND last.form IS NULL"""
