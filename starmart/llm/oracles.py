"""DuckDB SQL for the operators' queries that SQL can express; written from the contracts."""

ORACLES: dict[str, str] = {}

# Lines by list functions, keys counted by document, kept lines put together by place.
ORACLES["op1_line_dedup"] = """
WITH placed AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT doc_id, place, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM placed),
shared AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) > 1)
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (keeper <> doc_id)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                       FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (k) GROUP BY doc_id
"""

# Windows as joined strings: each start of a document's words against the windows of each size.
ORACLES["op4_decontaminate"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
met AS (
  SELECT s.doc_id, s.i, z.size, x.item
  FROM starts s JOIN sizes z ON s.i + z.size - 1 <= len(s.w)
  JOIN windows x ON x.size = z.size AND x.gram = array_to_string(s.w[s.i : s.i + z.size - 1], ' ')),
hit AS (
  SELECT doc_id, count(DISTINCT spot) AS n
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM met) GROUP BY doc_id),
owners AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit,
       coalesce(o.n, 0)::BIGINT AS n_items, sha256(coalesce(o.items, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(d.w) AS contaminated
FROM words d LEFT JOIN hit h USING (doc_id) LEFT JOIN owners o USING (doc_id)
"""

# Targets: the sources held at three times their size are those first by size per weight; the level
# of the rest decides how many. Takings: documents of three rounds in the order of finish times.
ORACLES["op10_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(doc_id::VARCHAR) AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         source_size * 3.0::DOUBLE AS most, (sum(source_size) OVER ())::DOUBLE AS total
  FROM sources),
levels AS (
  SELECT *, (total - coalesce(sum(most) OVER earlier, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) > most / weight AS held
  FROM weighed
  WINDOW earlier AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, rank, source_size, total, CASE WHEN held THEN most ELSE
         weight * ((total - sum(CASE WHEN held THEN most ELSE 0 END) OVER ())
                   / sum(CASE WHEN held THEN 0 ELSE weight END) OVER ()) END AS target
  FROM levels),
queued AS (
  SELECT s.*, t.rank, t.source_size, t.target, t.total,
         (sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
turns AS (SELECT *, unnest(range(3)) AS turn FROM queued),
finished AS (SELECT *, (turn * source_size + upto)::DOUBLE / nullif(target, 0) AS finish FROM turns),
cut AS (
  SELECT *, sum(size) OVER (ORDER BY finish NULLS LAST, rank, turn, h, doc_id ROWS UNBOUNDED PRECEDING) AS total_upto
  FROM finished)
SELECT doc_id, size, source_size, target,
       (sum(CASE WHEN total_upto <= total AND finish IS NOT NULL THEN 1 ELSE 0 END))::BIGINT AS copies,
       (size * sum(CASE WHEN total_upto <= total AND finish IS NOT NULL THEN 1 ELSE 0 END))::BIGINT AS taken
FROM cut GROUP BY doc_id, size, source_size, target
"""
