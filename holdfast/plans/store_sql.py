"""SQL twins of the chunk-store queries."""

from __future__ import annotations

FILES = """
n AS (SELECT count(*) AS n FROM supplier),
files AS (
  SELECT source || '/' || CAST(doc_id AS VARCHAR) AS filename, doc_id, encode(text) AS data,
    TIMESTAMP '2024-01-01' + to_minutes(CAST(doc_id AS INT)) AS ts FROM documents),
chunks AS (
  SELECT filename, doc_id, ts, i AS chunk_no, array_slice(data, i*1024 + 1, (i + 1)*1024) AS data
  FROM files, unnest(range(0, (octet_length(data) + 1023) // 1024)) AS t(i))"""

REPLICAS = """
copies AS (
  SELECT filename, doc_id, chunk_no, r AS rank, (doc_id*7 + chunk_no*3 + r) % n AS node, data,
    (doc_id*31 + chunk_no*7 + r) % 11 AS fate, octet_length(data) AS size
  FROM chunks, n, unnest(range(0, 3)) AS t(r)),
spots AS (SELECT *, ((doc_id + chunk_no) % ((size + 127) // 128))*128 + 1 AS spot FROM copies),
store AS (
  SELECT filename, chunk_no, rank, node, CASE fate
    WHEN 0 THEN (CASE WHEN spot > 1 THEN array_slice(data, 1, spot - 1) ELSE ''::BLOB END) || '\\x00'::BLOB
      || (CASE WHEN spot < size THEN array_slice(data, spot + 1, size) ELSE ''::BLOB END)
    WHEN 1 THEN CASE WHEN size // 2 > 0 THEN array_slice(data, 1, size // 2) ELSE ''::BLOB END
    WHEN 2 THEN data || encode(repeat('+', CASE WHEN doc_id % 2 = 0 THEN 5 ELSE 150 END))
    ELSE data END AS data
  FROM spots WHERE fate <> 3)"""

SLICES = """
want AS (
  SELECT filename, chunk_no, i AS slice_no, sha1(array_slice(data, i*128 + 1, (i + 1)*128)) AS sha
  FROM chunks, unnest(range(0, (octet_length(data) + 127) // 128)) AS t(i)),
have AS (
  SELECT filename, chunk_no, node, i AS slice_no, sha1(array_slice(data, i*128 + 1, (i + 1)*128)) AS sha
  FROM store, unnest(range(0, (octet_length(data) + 127) // 128)) AS t(i)),
sizes AS (
  SELECT c.filename, c.chunk_no, c.rank, c.node, (c.size + 127) // 128 AS wanted, c.data AS original,
    s.data AS held, (octet_length(s.data) + 127) // 128 AS found
  FROM copies c LEFT JOIN store s USING (filename, chunk_no, node)),
status AS (
  SELECT *, CASE WHEN held IS NULL THEN 'missing' WHEN held = original THEN 'healthy' ELSE 'corrupt' END AS status FROM sizes),
wrong AS (
  SELECT s.filename, s.chunk_no, s.node, w.slice_no, s.wanted, s.found
  FROM status s JOIN want w USING (filename, chunk_no)
  LEFT JOIN have h ON h.filename = s.filename AND h.chunk_no = s.chunk_no AND h.node = s.node AND h.slice_no = w.slice_no
  WHERE s.status = 'corrupt' AND (h.sha IS NULL OR h.sha <> w.sha)),
firsts AS (SELECT filename, chunk_no, node, min(slice_no) AS f FROM wrong WHERE wanted < found GROUP BY ALL),
bad AS (
  SELECT filename, chunk_no, node, slice_no FROM wrong WHERE wanted >= found
  UNION ALL SELECT f.filename, f.chunk_no, f.node, w.slice_no FROM firsts f JOIN want w USING (filename, chunk_no) WHERE w.slice_no >= f.f)"""

SHARDS = """
framed AS (
  SELECT filename, doc_id, chunk_no, (octet_length(data) + 4 + 5) // 6 AS step,
    unhex(lpad(hex(octet_length(data)), 8, '0')) || data
      || unhex(repeat('00', CAST(((octet_length(data) + 9) // 6)*6 - octet_length(data) - 4 AS BIGINT))) AS frame FROM chunks),
shards AS (
  SELECT filename, doc_id, chunk_no, s AS shard_no, array_slice(frame, (s - 1)*step + 1, s*step) AS data
  FROM framed, unnest(range(1, 7)) AS t(s)),
kept AS (
  SELECT filename, chunk_no, s AS shard_no, data FROM chunks, unnest(range(1, 10)) AS t(s)
  WHERE (s + doc_id + chunk_no) % 9 >= (doc_id*3 + chunk_no) % 5)"""

TRAFFIC = """
n AS (SELECT count(*) AS n FROM supplier),
hb AS (
  SELECT event_id AS seq, ts, user_id % n AS node, CAST(round(value*100) AS BIGINT) AS free_space
  FROM events, n WHERE event_type <> 'purchase'),
req AS (SELECT event_id AS seq FROM events WHERE event_type = 'purchase')"""

PLACED = TRAFFIC + """,
state AS (
  SELECT r.seq, h.node, arg_max(h.free_space, h.seq) AS free_space FROM req r JOIN hb h ON h.seq < r.seq GROUP BY 1, 2),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY seq ORDER BY free_space DESC, node) AS rank, count(*) OVER (PARTITION BY seq) AS known FROM state)"""

EVENTS = """
n AS (SELECT count(*) AS n FROM supplier),
raw AS (
  SELECT event_id AS seq,
    CASE event_type WHEN 'view' THEN 'store' WHEN 'click' THEN 'corrupt' WHEN 'purchase' THEN 'fixed'
      WHEN 'error' THEN 'deleted' ELSE 'dead' END AS kind,
    CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id % 97 END AS chunk, value FROM events),
banded AS (SELECT seq, kind, chunk, CAST((chunk*5 + CAST(floor(value) AS BIGINT) % 6) % n AS BIGINT) AS node, n FROM raw, n),
on_chunk AS (
  SELECT seq, kind, chunk, CASE WHEN kind = 'store' THEN [node, (node + 1) % n, (node + 2) % n] ELSE [node] END AS nodes
  FROM banded WHERE kind <> 'dead'),
mentions AS (SELECT DISTINCT chunk, unnest(nodes) AS node FROM on_chunk),
deaths AS (
  SELECT b.seq, 'dead' AS kind, m.chunk, [b.node] AS nodes FROM banded b JOIN mentions m USING (node) WHERE b.kind = 'dead'),
history AS (
  SELECT chunk, list({'seq': seq, 'kind': kind, 'nodes': nodes} ORDER BY seq) AS steps
  FROM (SELECT seq, kind, chunk, nodes FROM on_chunk UNION ALL SELECT seq, kind, chunk, nodes FROM deaths) GROUP BY chunk)"""
