"""SQL twins of the key-ring queries."""

from __future__ import annotations

PEERS = """
peers AS (
  SELECT min(s_suppkey) AS seq, id, arg_min(s_name, s_suppkey) AS nickname,
    'host' || CAST(arg_min(s_nationkey, s_suppkey) AS VARCHAR) AS host, 5000 + min(s_suppkey) AS port,
    CAST('0x' || id AS BIGINT) AS p
  FROM (SELECT *, upper(substr(sha1('peer-' || CAST(s_suppkey AS VARCHAR)), 1, 4)) AS id FROM supplier) GROUP BY id)"""

FILES = """
names AS (SELECT doc_id, source || '/' || CAST(doc_id AS VARCHAR) AS filename FROM documents),
stored AS (
  SELECT doc_id, filename, upper(substr(sha1(filename), 1, 3) || substr(sha1(filename), 6, 1)) AS key,
    CAST('0x' || substr(sha1(filename), 1, 3) || substr(sha1(filename), 6, 1) AS BIGINT) AS k FROM names)"""


def owners(peers: str, name: str, keys: str = "stored") -> str:
    """Owner of each key by looking at every peer."""
    return f"""
{name} AS (
  SELECT s.k, arg_min(p.p, least(abs(s.k - p.p), 65536 - abs(s.k - p.p))*65536 + (p.p - s.k + 65536) % 65536) AS owner
  FROM (SELECT DISTINCT k FROM {keys}) s, {peers} p GROUP BY s.k)"""


OWNED = owners("peers", "owned")

LEAVES = """
leaves AS (
  SELECT p AS peer, CASE WHEN l <> p THEN l END AS "left", CASE WHEN r <> p THEN r END AS "right" FROM (
    SELECT p, coalesce(lag(p) OVER (ORDER BY p), max(p) OVER ()) AS l, coalesce(lead(p) OVER (ORDER BY p), min(p) OVER ()) AS r FROM peers))"""

CELLS = """
cells AS (
  SELECT a.p AS peer, i AS row_no, substr(b.id, 1, i + 1) AS prefix,
    arg_min(b.p, least(abs(a.p - b.p), 65536 - abs(a.p - b.p))*65536 + (b.p - a.p + 65536) % 65536) AS target
  FROM peers a, peers b, (VALUES (0), (1), (2), (3)) AS t(i)
  WHERE substr(a.id, 1, i) = substr(b.id, 1, i) AND substr(a.id, i + 1, 1) <> substr(b.id, i + 1, 1) GROUP BY 1, 2, 3)"""

ENTRIES = """
listed AS (SELECT id, p, row_number() OVER (ORDER BY id) AS number, count(*) OVER () AS total FROM peers),
starts AS (
  SELECT s.doc_id, s.filename, s.key, s.k, l.id AS entry, l.p AS e FROM stored s
  JOIN listed l ON l.number = CAST('0x' || substr(sha1(s.filename), 9, 8) AS BIGINT) % l.total + 1)"""
