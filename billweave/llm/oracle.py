"""The queries that SQL can express, as SQL over the same tables."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)
), twice AS (
  SELECT doc_id, win FROM windows GROUP BY doc_id, win HAVING count(*) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM windows JOIN twice USING (doc_id, win))
  GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_same,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclamations
  FROM d LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words
            OR 100 * n_capitals > 45 * word_chars OR 2 * n_exclamations > n_words
            OR 100 * n_same > 30 * n_words OR 100 * n_dup_lines > 60 * n_lines) AS kept
FROM m
"""

_LINES = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split
), common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (common.key IS NULL), '') AS text
  FROM keyed LEFT JOIN common USING (key) GROUP BY doc_id
)
"""
OP7 = _LINES + "SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept"

# With sources sorted by stop per weight, the level at which the words run out.
_MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS key
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank, 3 * source_size AS stop FROM per_source
), weighted AS (
  SELECT *, (rank - 1) % 3 + 1 AS weight FROM ranked
), filled AS (
  SELECT *, row_number() OVER w AS spot,
         (sum(source_size) OVER () - coalesce(sum(stop) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS rest,
         (sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS weights
  FROM weighted WINDOW w AS (ORDER BY stop::DOUBLE / weight, rank)
), level AS (
  SELECT rest, weights FROM filled WHERE rest * weight / weights <= stop ORDER BY spot LIMIT 1
), targets AS (
  SELECT f.source, f.rank, f.source_size, least(level.rest * f.weight / level.weights, f.stop::DOUBLE) AS target
  FROM filled f, level
), queued AS (
  SELECT s.*, t.rank, t.source_size, t.target,
         (sum(size) OVER (PARTITION BY t.rank ORDER BY key, size ROWS UNBOUNDED PRECEDING))::BIGINT AS sent
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), entries AS (
  SELECT doc_id, size, rank, key, turn, (turn * source_size + sent)::DOUBLE / target AS finish
  FROM queued, range(3) r(turn)
  WHERE source_size > 0 AND target > 0 AND turn < least(3, floor(target / source_size) + 1)
), merged AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY finish, rank, turn, key ROWS UNBOUNDED PRECEDING) AS words FROM entries
), counted AS (
  SELECT doc_id, count(*)::INT AS copies, sum(size)::BIGINT AS taken
  FROM merged WHERE words <= (SELECT sum(size) FROM sized) GROUP BY doc_id
)
"""
OP6 = _MIX + """
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(c.taken, 0) AS taken
FROM queued q LEFT JOIN counted c USING (doc_id)
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def shingles(name: str, key: str, table: str) -> str:
    """CTEs: ``name`` has the distinct five-word shingles s of each text."""
    return rf"""
{name}_words AS (
  SELECT {key}, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM {table}
), {name} AS (
  SELECT DISTINCT {key}, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM {name}_words WHERE len(w) > 0)
)"""


OP10 = rf"""
WITH {shingles("d", "doc_id", "documents")}, {shingles("b", "item_id", "benchmark")},
sizes AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id),
both_have AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN b USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n AS item_shingles, shared AS shared_shingles, shared::DOUBLE / n AS containment
FROM both_have JOIN sizes USING (item_id) WHERE 100 * shared >= 75 * n
"""

OP9 = rf"""
WITH RECURSIVE {shingles("d", "doc_id", "documents")},
sizes AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM d x JOIN d y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 75 * (x.n + y.n - shared)
), reach AS (
  SELECT doc_id, doc_id AS other FROM sizes
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), least_id AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       coalesce(component_id, doc_id) = doc_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_id USING (doc_id)
"""



def _tree(name: str, levels: int = 4) -> str:
    """CTEs: ``name``_0 to ``name``_4 are the nodes of the tree over the records ``name``."""
    parts = [f"""{name}_0 AS (
  SELECT file, ("offset" // 65536)::BIGINT AS node,
         sha256(string_agg("offset" || ':' || length || ':' || digest, ',' ORDER BY "offset")) AS hash
  FROM {name} GROUP BY 1, 2)"""]
    for level in range(1, levels + 1):
        parts.append(f"""{name}_{level} AS (
  SELECT file, n AS node, sha256(string_agg(node || ':' || hash, ',' ORDER BY node)) AS hash
  FROM (SELECT *, node // 16 AS n FROM {name}_{level - 1}) GROUP BY file, n)""")
    return ", ".join(parts)


OP5 = rf"""
WITH made AS (
  SELECT page_id, coalesce(url, '') AS url,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: '
         || coalesce(url, '') || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '')
         || '>' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10)
         || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages
), hashed AS (
  SELECT page_id, url, strlen(record) AS length, sha256(record) AS digest FROM made
), filed AS (
  SELECT *, coalesce('pages-' || floor(page_id / 256)::BIGINT, 'pages-x' || substr(digest, 1, 3)) AS file FROM hashed
), a AS (
  SELECT file, length, digest, coalesce(sum(length) OVER (
           PARTITION BY file ORDER BY page_id, url, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
         ), 0)::BIGINT AS "offset" FROM filed
), b AS (
  SELECT file, length, "offset",
         CASE WHEN substr(digest, 1, 2) IN ('00', '01', '02', '03') THEN sha256('damaged ' || digest) ELSE digest END AS digest
  FROM a WHERE NOT starts_with(digest, 'ff')
), {_tree("a")}, {_tree("b")}, damage AS (
  SELECT file, count(b.digest) AS n_changed, count(*) - count(b.digest) AS n_missing,
         string_agg("offset"::VARCHAR, ',' ORDER BY "offset") AS offsets
  FROM a LEFT JOIN b USING (file, "offset") WHERE a.digest IS DISTINCT FROM b.digest GROUP BY file
), files AS (
  SELECT file, count(*) AS n_records, sum(length)::BIGINT AS n_bytes FROM a GROUP BY file
)
SELECT file, n_records, n_bytes, a_4.hash AS primary_root, b_4.hash AS replica_root,
       coalesce(n_changed, 0) AS n_changed, coalesce(n_missing, 0) AS n_missing, coalesce(offsets, '') AS offsets
FROM files JOIN a_4 USING (file) LEFT JOIN b_4 USING (file) LEFT JOIN damage USING (file)
"""



def _over(sql: str, documents: str) -> str:
    return "(" + sql.replace("FROM documents", f"FROM {documents}") + ")"


PIPELINE = f"""
WITH passing AS MATERIALIZED (
  SELECT d.* FROM documents d JOIN {_over(OP3, "documents")} v USING (doc_id) WHERE v.kept
), lined AS MATERIALIZED (
  SELECT doc_id, CASE WHEN n_dropped = 0 THEN d.text ELSE k.text END AS text, source
  FROM passing d JOIN {_over(_LINES + "SELECT * FROM kept", "passing")} k USING (doc_id)
), apart AS MATERIALIZED (
  SELECT d.* FROM lined d JOIN {_over(OP9, "lined")} v USING (doc_id) WHERE v.kept
), clean AS MATERIALIZED (
  SELECT * FROM apart WHERE doc_id NOT IN (SELECT doc_id FROM {_over(OP10, "apart")})
)
SELECT * FROM {_over(_MIX + """
  SELECT q.doc_id, q.source, q.size, q.source_size, q.target, c.copies, c.taken
  FROM queued q JOIN counted c USING (doc_id)""", "clean")}
"""

ORACLES = {
    "op3_quality_rules": OP3,
    "op5_warc_audit": OP5,
    "op6_mixing": OP6,
    "op7_line_dedup": OP7,
    "op9_near_dedup": OP9,
    "op10_decontaminate": OP10,
}
