"""Registered queries over the key ring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions import ring as rx
from holdfast.operators import ring, routing
from holdfast.plans.delay_sql import stmt
from holdfast.plans.registry import query
from holdfast.plans.ring_sql import CELLS, ENTRIES, FILES, LEAVES, OWNED, PEERS, owners
from holdfast.sources import ring_tables as rt
from holdfast.sources.tables import table


def _hex(*names: str) -> list[Column]:
    return [rx.to_hex(F.col(n)).alias(n) for n in names]


def _h(expr: str) -> str:
    return f"CASE WHEN {expr} IS NOT NULL THEN upper(printf('%04x', {expr})) END"


# ---- identifiers and distances ------------------------------------------------------------------

@query("ring_keys", stmt(FILES, body="SELECT filename, key, k AS key_int FROM stored"))
def ring_keys(spark: SparkSession, sf: str) -> DataFrame:
    return rt.stored_files(spark, sf).select("filename", "key", rx.to_int(F.col("key")).cast("bigint").alias("key_int"))


@query("ring_peer_ids", "SELECT event_id, upper(printf('%04x', epoch_us(ts) % 65536)) AS id FROM events")
def ring_peer_ids(spark: SparkSession, sf: str) -> DataFrame:
    clock = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return table(spark, sf, "events").select("event_id", rx.to_hex(F.pmod(clock, F.lit(rx.SPACE))).alias("id"))


_PAIRS = """
pairs AS (
  SELECT event_id AS pair, (event_id*40503) % 65536 AS a,
    ((event_id*40503) % 65536 + CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 32768 WHEN 2 THEN event_id % 17 ELSE user_id*7919 END) % 65536 AS b
  FROM events)"""


@query("ring_distances", stmt(_PAIRS, body="""
SELECT pair, a, b, (a - b + 65536) % 65536 AS to_left, CASE WHEN a < b THEN b - a ELSE 65536 - a + b END AS to_right,
  least(abs(a - b), 65536 - abs(a - b)) AS shortest,
  CASE WHEN a < b AND abs(a - b) < 32768 THEN 'CLOCKWISE' WHEN a < b THEN 'COUNTER_CLOCKWISE'
    WHEN abs(a - b) < 32768 THEN 'COUNTER_CLOCKWISE' ELSE 'CLOCKWISE' END AS direction FROM pairs"""))
def ring_distances(spark: SparkSession, sf: str) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    big = lambda c, name: c.cast("bigint").alias(name)
    return rt.pairs(spark, sf).select(
        "pair", big(a, "a"), big(b, "b"), big(rx.left_distance(a, b), "to_left"), big(rx.right_distance(a, b), "to_right"),
        big(rx.distance(a, b), "shortest"), rx.direction(a, b).alias("direction"),
    )


@query("ring_prefix_index", stmt(_PAIRS, """
texts AS (SELECT pair, upper(printf('%04x', a)) AS a, upper(printf('%04x', b)) AS b FROM pairs)""", body="""
SELECT pair, a, b, CAST(coalesce(list_min(list_filter(range(0, 4), lambda i: a[i + 1] <> b[i + 1])), 0) AS BIGINT) AS differs_at FROM texts"""))
def ring_prefix_index(spark: SparkSession, sf: str) -> DataFrame:
    texts = rt.pairs(spark, sf).select("pair", *_hex("a", "b"))
    return texts.withColumn("differs_at", rx.first_difference(F.col("a"), F.col("b")).cast("bigint"))


# ---- membership ---------------------------------------------------------------------------------

_ASKED = """
asked AS (
  SELECT c_custkey AS seq, upper(substr(sha1('peer-' || CAST(c_custkey AS VARCHAR)), 1, 4)) AS id, c_name AS nickname FROM customer),
turns AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS turn FROM asked)"""


@query("ring_register", stmt(_ASKED, body="SELECT seq, id, nickname FROM turns WHERE turn = 1"))
def ring_register(spark: SparkSession, sf: str) -> DataFrame:
    return ring.register(rt.registrations(spark, sf))


@query("ring_id_conflicts", stmt(_ASKED, body="SELECT seq, id, nickname FROM turns WHERE turn > 1"))
def ring_id_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return ring.conflicts(rt.registrations(spark, sf))


@query("ring_peer_list", stmt(PEERS, body="""
SELECT row_number() OVER (ORDER BY id) AS number, count(*) OVER () AS total, id, host, port, nickname FROM peers"""))
def ring_peer_list(spark: SparkSession, sf: str) -> DataFrame:
    return ring.numbered(rt.peers(spark, sf)).select("number", "total", "id", "host", "port", "nickname")


@query("ring_leaf_set", stmt(PEERS, LEAVES, body=f"""SELECT {_h('peer')} AS peer, {_h('"left"')} AS "left", {_h('"right"')} AS "right" FROM leaves"""))
def ring_leaf_set(spark: SparkSession, sf: str) -> DataFrame:
    return ring.leaf_set(rt.peers(spark, sf)).select(*_hex("peer", "left", "right"))


@query("ring_routing_table", stmt(PEERS, CELLS, body=f"""
SELECT {_h('peer')} AS peer, CAST(row_no AS BIGINT) AS row_no, prefix, {_h('target')} AS target FROM cells"""))
def ring_routing_table(spark: SparkSession, sf: str) -> DataFrame:
    cells = routing.routing_table(rt.peers(spark, sf))
    return cells.select(*_hex("peer", "target"), F.col("row_no").cast("bigint").alias("row_no"), "prefix")


# ---- ownership and rebalancing ------------------------------------------------------------------

@query("ring_owner", stmt(PEERS, FILES, OWNED, body=f"SELECT filename, key, {_h('owner')} AS owner FROM stored JOIN owned USING (k)"))
def ring_owner(spark: SparkSession, sf: str) -> DataFrame:
    owned = ring.assign(rt.stored_files(spark, sf), rt.peers(spark, sf))
    return owned.select("filename", "key", *_hex("owner"))


@query("ring_files_per_peer", stmt(PEERS, FILES, OWNED, body=f"""
SELECT {_h('owner')} AS owner, filename, key, count(*) OVER (PARTITION BY owner) AS files FROM stored JOIN owned USING (k)"""))
def ring_files_per_peer(spark: SparkSession, sf: str) -> DataFrame:
    return ring.files_per_peer(ring_owner(spark, sf))


@query("ring_join_moves", stmt(PEERS, FILES, "earlier AS (SELECT * FROM peers WHERE seq < (SELECT max(seq) FROM peers))",
                               owners("earlier", "was"), owners("peers", "now"), body=f"""
SELECT filename, key, {_h('was.owner')} AS old_owner, {_h('now.owner')} AS new_owner
FROM stored JOIN was USING (k) JOIN now USING (k) WHERE was.owner <> now.owner"""))
def ring_join_moves(spark: SparkSession, sf: str) -> DataFrame:
    after = rt.peers(spark, sf)
    before = after.where(F.col("seq") < rt.newest(after))
    moves = ring.moved_by_join(rt.stored_files(spark, sf), before, after)
    return moves.select("filename", "key", *_hex("old_owner", "new_owner"))


_LEAVER = "leaver AS (SELECT arg_min(p, seq) AS gone FROM peers)"


def _leaver(peers: DataFrame) -> Column:
    return peers.agg(F.min_by(rx.to_int(F.col("id")), "seq")).scalar()


@query("ring_leave_moves", stmt(PEERS, FILES, OWNED, _LEAVER, "rest AS (SELECT peers.* FROM peers, leaver WHERE p <> gone)",
                                owners("rest", "later"), body=f"""
SELECT filename, key, {_h('owned.owner')} AS old_owner, {_h('later.owner')} AS new_owner
FROM stored JOIN owned USING (k) JOIN later USING (k), leaver WHERE owned.owner = gone"""))
def ring_leave_moves(spark: SparkSession, sf: str) -> DataFrame:
    peers = rt.peers(spark, sf)
    moves = ring.moved_by_leave(rt.stored_files(spark, sf), peers, _leaver(peers))
    return moves.select("filename", "key", *_hex("old_owner", "new_owner"))


@query("ring_after_leave", stmt(PEERS.replace("peers AS", "everyone AS"),
                                "peers AS (SELECT * FROM everyone WHERE seq > (SELECT min(seq) FROM everyone))", LEAVES, body=f"""
SELECT {_h('peer')} AS peer, {_h('"left"')} AS "left", {_h('"right"')} AS "right" FROM leaves"""))
def ring_after_leave(spark: SparkSession, sf: str) -> DataFrame:
    peers = rt.peers(spark, sf)
    rest = peers.where(rx.to_int(F.col("id")) != _leaver(peers))
    return ring.leaf_set(rest).select(*_hex("peer", "left", "right"))


@query("ring_after_leave_routing", stmt(PEERS, CELLS, _LEAVER, body=f"""
SELECT {_h('peer')} AS peer, CAST(row_no AS BIGINT) AS row_no, prefix, {_h('target')} AS target
FROM cells, leaver WHERE target <> gone AND peer <> gone"""))
def ring_after_leave_routing(spark: SparkSession, sf: str) -> DataFrame:
    peers = rt.peers(spark, sf)
    gone = _leaver(peers)
    kept = routing.routing_table(peers).where((F.col("target") != gone) & (F.col("peer") != gone))
    return kept.select(*_hex("peer", "target"), F.col("row_no").cast("bigint").alias("row_no"), "prefix")


_WALK = """
SELECT string_agg(upper(printf('%04x', p)), '-' ORDER BY {by}) AS hex_trace, string_agg(CAST(p AS VARCHAR), '-' ORDER BY {by}) AS decimal_trace,
  any_value(upper(printf('%04x', gone))) AS origin FROM peers, leaver"""


@query("ring_trace_left", stmt(PEERS, _LEAVER, body=_WALK.format(by="(gone - p + 65536) % 65536")))
def ring_trace_left(spark: SparkSession, sf: str) -> DataFrame:
    peers = rt.peers(spark, sf)
    return ring.trace(peers, _leaver(peers), leftward=True)


@query("ring_trace_right", stmt(PEERS, _LEAVER, body=_WALK.format(by="(p - gone + 65536) % 65536")))
def ring_trace_right(spark: SparkSession, sf: str) -> DataFrame:
    peers = rt.peers(spark, sf)
    return ring.trace(peers, _leaver(peers), leftward=False)


# ---- look-ups -----------------------------------------------------------------------------------

_ASKS = """
asks AS (
  SELECT doc_id AS request, CASE WHEN doc_id % 7 = 0 THEN filename || '?' ELSE filename END AS filename,
    upper(CASE WHEN doc_id % 5 = 0 THEN reverse(key) ELSE lower(key) END) AS key FROM stored)"""


def _asked_and_stored(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    peers = rt.peers(spark, sf)
    asked = ring.assign(rt.read_requests(spark, sf), peers).select("request", "filename", "key", *_hex("owner"))
    stored = ring.assign(rt.stored_files(spark, sf), peers).select("filename", "key", *_hex("owner"))
    return asked, stored


@query("ring_read_hits", stmt(PEERS, FILES, _ASKS, owners("peers", "spots", "(SELECT CAST('0x' || key AS BIGINT) AS k FROM asks)"), body=f"""
SELECT request, filename, key, {_h('owner')} AS owner FROM asks JOIN spots ON spots.k = CAST('0x' || key AS BIGINT)
WHERE (filename, key) IN (SELECT (filename, key) FROM stored)"""))
def ring_read_hits(spark: SparkSession, sf: str) -> DataFrame:
    return ring.read_hits(*_asked_and_stored(spark, sf))


@query("ring_read_misses", stmt(PEERS, FILES, _ASKS, owners("peers", "spots", "(SELECT CAST('0x' || key AS BIGINT) AS k FROM asks)"), body=f"""
SELECT request, filename, key, {_h('owner')} AS owner FROM asks JOIN spots ON spots.k = CAST('0x' || key AS BIGINT)
WHERE (filename, key) NOT IN (SELECT (filename, key) FROM stored)"""))
def ring_read_misses(spark: SparkSession, sf: str) -> DataFrame:
    return ring.read_misses(*_asked_and_stored(spark, sf))


@query("ring_entry_peer", stmt(PEERS, FILES, ENTRIES, body="SELECT filename, key, entry FROM starts"))
def ring_entry_peer(spark: SparkSession, sf: str) -> DataFrame:
    return ring.entry_peer(rt.stored_files(spark, sf), rt.peers(spark, sf), "filename").select("filename", "key", "entry")
