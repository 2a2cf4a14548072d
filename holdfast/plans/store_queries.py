"""Registered queries over chunk, replica, shard and heartbeat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators import chunks, erasure, placement, replica_lists, running
from holdfast.plans.delay_sql import stmt
from holdfast.plans.registry import query
from holdfast.plans.store_sql import EVENTS, FILES, PLACED, REPLICAS, SHARDS, SLICES, TRAFFIC
from holdfast.session import fresh_path
from holdfast.sources import binary_files, byte_ranges
from holdfast.sources import store_tables as st

BLOCK = running.BLOCK_ROWS
# Bytes of a reassembled part, for the SQL twins.
PART = chunks.CHUNKS_PER_PART * st.CHUNK_BYTES


_PARTS = f"""SELECT filename, p AS part_no, CAST(octet_length(array_slice(data, p*{PART} + 1, (p + 1)*{PART})) AS BIGINT) AS n_bytes,
  sha1(array_slice(data, p*{PART} + 1, (p + 1)*{PART})) AS sha1
FROM files, unnest(range(0, (octet_length(data) + {PART - 1}) // {PART})) AS t(p)"""


def _digest(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, F.length("data").cast("bigint").alias("n_bytes"), F.sha1("data").alias("sha1"))


def _scrubbed(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.scrub(st.manifest(spark, sf), st.replica_list(spark, sf), st.replica_store(spark, sf), st.SLICE_BYTES)


# ---- files and chunks ---------------------------------------------------------------------------

@query("src_binary_files", """
SELECT sha1(line) AS sha1, count(*) AS copies, CAST(octet_length(encode(any_value(line))) AS BIGINT) AS n_bytes
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""")
def src_binary_files(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "files")
    binary_files.write_lines(st.table(spark, sf, "documents").select("text"), path)
    lines = binary_files.lines(binary_files.read(spark, path))
    return lines.groupBy(F.sha1("line").alias("sha1")).agg(
        F.count("*").alias("copies"), F.max(F.octet_length("line")).cast("bigint").alias("n_bytes")
    )


#: Documents in one of the files that are read back by ranges, and the range sizes of that query.
DOCS_PER_FILE, RANGE_CHUNK, RANGE_BYTES = 250, 4096, 65_536
#: Tasks that read the ranges, for each core, while these have no more bytes than a task may have.
TASKS_PER_CORE = 3


@query("src_binary_chunks", f"""
WITH files AS (
  SELECT doc_id // {DOCS_PER_FILE} AS file_no, encode(string_agg(text || chr(10), '' ORDER BY doc_id)) AS data FROM documents GROUP BY 1)
SELECT file_no, i AS chunk_no, CAST(octet_length(data) AS BIGINT) AS file_bytes,
  CAST(octet_length(array_slice(data, i*{RANGE_CHUNK} + 1, (i + 1)*{RANGE_CHUNK})) AS BIGINT) AS n_bytes,
  sha1(array_slice(data, i*{RANGE_CHUNK} + 1, (i + 1)*{RANGE_CHUNK})) AS sha1
FROM files, unnest(range(0, (octet_length(data) + {RANGE_CHUNK - 1}) // {RANGE_CHUNK})) AS t(i)""")
def src_binary_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Files of documents read back as chunks, by byte ranges."""
    path = fresh_path(spark, "ranged-files")
    docs = st.table(spark, sf, "documents").select("doc_id", "text")
    files = docs.agg(F.floor(F.max("doc_id") / DOCS_PER_FILE).cast("int") + 1).first()[0]
    number = F.coalesce(F.pmod(F.floor(F.col("doc_id") / DOCS_PER_FILE).cast("int"), F.lit(files)), F.lit(0)).alias("file_no")
    # a task writes many files, one after the other: all rows of a file are in one task and in order
    placed = docs.select(number, "doc_id", "text").repartition("file_no").sortWithinPartitions("file_no", "doc_id")
    placed.select("file_no", "text").write.partitionBy("file_no").text(path)
    rows = byte_ranges.read_chunks(spark, path, RANGE_CHUNK, RANGE_BYTES, tasks=TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    file_no = F.regexp_extract("path", r"/file_no=(\d+)/[^/]*$", 1).cast("bigint").alias("file_no")
    return _digest(rows.select(file_no, "file_bytes", "chunk_no", "data"), "file_no", "file_bytes", "chunk_no")


@query("sink_chunk_table", stmt(FILES, body="""
SELECT filename, chunk_no, filename || '_chunk' || CAST(chunk_no + 1 AS VARCHAR) AS path_name, CAST(1 AS BIGINT) AS version,
  ts, CAST(octet_length(data) AS BIGINT) AS n_bytes, sha1(data) AS sha1 FROM chunks"""))
def sink_chunk_table(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "chunk-table")
    binary_files.write_chunk_table(st.file_chunks(spark, sf), st.manifest(spark, sf), path)
    data, meta = binary_files.read_chunk_table(spark, path)
    named = meta.select("filename", "chunk_no", "path_name", "version", "ts")
    return _digest(data, "filename", "chunk_no").join(named, ["filename", "chunk_no"])


@query("dfs_chunks", stmt(FILES, body="""
SELECT filename, chunk_no, CAST(octet_length(data) AS BIGINT) AS n_bytes, sha1(data) AS sha1 FROM chunks"""))
def dfs_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return _digest(st.file_chunks(spark, sf), "filename", "chunk_no")


@query("dfs_slice_checksums", stmt(FILES, REPLICAS, SLICES, body="SELECT filename, chunk_no, slice_no, sha AS sha1 FROM want"))
def dfs_slice_checksums(spark: SparkSession, sf: str) -> DataFrame:
    listed = st.manifest(spark, sf).select("filename", "chunk_no", F.posexplode("stored").alias("slice_no", "sha1"))
    return listed.withColumn("slice_no", F.col("slice_no").cast("bigint"))


@query("dfs_manifest", stmt(FILES, body="""
SELECT filename, chunk_no, filename || '_chunk' || CAST(chunk_no + 1 AS VARCHAR) AS path_name, CAST(1 AS BIGINT) AS version,
  ts, CAST(octet_length(data) AS BIGINT) AS n_bytes, CAST((octet_length(data) + 127) // 128 AS BIGINT) AS slices FROM chunks"""))
def dfs_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return st.manifest(spark, sf).withColumn("slices", F.size("stored").cast("bigint")).drop("stored")


# ---- replicas: scrub and repair -----------------------------------------------------------------

@query("dfs_scrub_status", stmt(FILES, REPLICAS, SLICES, body="SELECT filename, chunk_no, rank, node, status FROM status"))
def dfs_scrub_status(spark: SparkSession, sf: str) -> DataFrame:
    return _scrubbed(spark, sf).select("filename", "chunk_no", "rank", "node", "status")


@query("dfs_bad_slices", stmt(FILES, REPLICAS, SLICES, body="SELECT filename, chunk_no, node, slice_no FROM bad"))
def dfs_bad_slices(spark: SparkSession, sf: str) -> DataFrame:
    corrupt = _scrubbed(spark, sf).where(F.col("status") == "corrupt")
    listed = corrupt.select("filename", "chunk_no", "node", F.explode("bad").alias("slice_no"))
    return listed.withColumn("slice_no", F.col("slice_no").cast("bigint"))


@query("dfs_missing_replicas", stmt(FILES, REPLICAS, body="SELECT filename, chunk_no, rank, node FROM copies WHERE fate = 3"))
def dfs_missing_replicas(spark: SparkSession, sf: str) -> DataFrame:
    missing = chunks.missing_replicas(st.replica_list(spark, sf), st.replica_store(spark, sf))
    return missing.select("filename", "chunk_no", "rank", "node")


@query("dfs_repaired", stmt(FILES, REPLICAS, SLICES, """
donors AS (SELECT filename, chunk_no, arg_min(node, rank) AS donor FROM status WHERE status = 'healthy' GROUP BY ALL)""", body="""
SELECT filename, chunk_no, rank, node, donor, status, CAST(2 AS BIGINT) AS version,
  CAST(octet_length(original) AS BIGINT) AS n_bytes, sha1(original) AS sha1
FROM status JOIN donors USING (filename, chunk_no) WHERE status <> 'healthy'"""))
def dfs_repaired(spark: SparkSession, sf: str) -> DataFrame:
    fixed = chunks.repair(_scrubbed(spark, sf), st.replica_store(spark, sf), st.SLICE_BYTES)
    return _digest(fixed, "filename", "chunk_no", "rank", "node", "donor", "status", "version")


@query("dfs_recoverability", stmt(FILES, REPLICAS, SLICES, body="""
SELECT filename, chunk_no, count(*) FILTER (status = 'healthy') AS healthy, count(*) FILTER (status = 'healthy') >= 1 AS recoverable
FROM status GROUP BY filename, chunk_no"""))
def dfs_recoverability(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.recoverability(_scrubbed(spark, sf))


@query("dfs_read_plan", stmt(FILES, REPLICAS, body="""
SELECT filename, chunk_no, arg_min(node, rank) AS node, count(*) OVER (PARTITION BY filename) AS total_chunks
FROM copies GROUP BY filename, chunk_no"""))
def dfs_read_plan(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.read_plan(st.replica_list(spark, sf))


@query("dfs_reassembled", stmt(FILES, """
lost AS (SELECT DISTINCT doc_id FROM chunks WHERE doc_id % 10 = 0 AND chunk_no = 1 OR doc_id % 17 = 3 AND chunk_no = 0)""", body=f"""
{_PARTS} WHERE doc_id NOT IN (SELECT doc_id FROM lost)"""))
def dfs_reassembled(spark: SparkSession, sf: str) -> DataFrame:
    """Some chunks never arrive, some arrive twice, some of those altered, and some arrive only altered."""
    stored = st.file_chunks(spark, sf)
    kept = stored.where(~((F.col("doc_id") % 10 == 0) & (F.col("chunk_no") == 1)))
    turn = F.col("doc_id") + F.col("chunk_no")
    altered = F.concat(F.lit(b"\x00"), F.col("data").substr(F.lit(2), F.length("data")))
    first = kept.withColumn("data", F.when((F.col("doc_id") % 17 == 3) & (F.col("chunk_no") == 0), altered).otherwise(F.col("data")))
    again = first.where(turn % 3 == 0).withColumn("data", F.when(turn % 6 == 0, altered).otherwise(F.col("data")))
    totals = chunks.numbers(st.files(spark, sf), st.CHUNK_BYTES).groupBy("filename").agg(F.count("*").alias("total_chunks"))
    whole = chunks.reassemble(first.unionByName(again), totals, manifest=st.manifest(spark, sf), slice_bytes=st.SLICE_BYTES)
    return _digest(whole, "filename", "part_no")


@query("dfs_node_inventory", stmt(FILES, REPLICAS, body="""
SELECT s_suppkey AS node, count(filename) AS held, CAST(coalesce(sum(octet_length(data)), 0) AS BIGINT) AS held_bytes,
  CAST(CAST(round(any_value(s_acctbal)*100) AS BIGINT) - coalesce(sum(octet_length(data)), 0) AS BIGINT) AS space_left
FROM supplier LEFT JOIN store ON node = s_suppkey GROUP BY s_suppkey"""))
def dfs_node_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.node_inventory(st.replica_store(spark, sf), st.nodes(spark, sf))


@query("dfs_storage_overhead", stmt(FILES, body="""
SELECT 'replication' AS scheme, CAST(sum(octet_length(data)) AS BIGINT) AS payload_bytes,
  CAST(3*sum(octet_length(data)) AS BIGINT) AS stored_bytes, 3*sum(octet_length(data)) / sum(octet_length(data)) AS overhead FROM chunks
UNION ALL SELECT 'erasure', CAST(sum(octet_length(data)) AS BIGINT), CAST(sum(9*((octet_length(data) + 9) // 6)) AS BIGINT),
  sum(9*((octet_length(data) + 9) // 6)) / sum(octet_length(data)) FROM chunks"""))
def dfs_storage_overhead(spark: SparkSession, sf: str) -> DataFrame:
    return erasure.storage_overhead(st.file_chunks(spark, sf), st.COPIES)


# ---- placement ----------------------------------------------------------------------------------

@query("dfs_placement", stmt(PLACED, body="SELECT seq, rank, node FROM placed WHERE known >= 3 AND rank <= 3"))
def dfs_placement(spark: SparkSession, sf: str) -> DataFrame:
    return placement.place(st.placement_requests(spark, sf), st.heartbeats(spark, sf), st.COPIES, BLOCK)


@query("dfs_shard_placement", stmt(PLACED, body="SELECT seq, rank AS shard_no, node FROM placed WHERE known >= 9 AND rank <= 9"))
def dfs_shard_placement(spark: SparkSession, sf: str) -> DataFrame:
    placed = placement.place(st.placement_requests(spark, sf), st.heartbeats(spark, sf), erasure.TOTAL_SHARDS, BLOCK)
    return placed.withColumnRenamed("rank", "shard_no")


@query("dfs_placement_rejects", stmt(TRAFFIC, """
known AS (SELECT r.seq, (SELECT count(DISTINCT node) FROM hb WHERE hb.seq < r.seq) AS nodes FROM req r)""", body="""
SELECT seq, CAST(copies AS BIGINT) AS copies, CASE WHEN nodes >= copies THEN 'placed' ELSE 'rejected' END AS status
FROM known, unnest([3, 9]) AS t(copies)"""))
def dfs_placement_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Both schemes: three replicas, and the nine shards of erasure coding."""
    asked, reports = st.placement_requests(spark, sf), st.heartbeats(spark, sf)
    chunks_, shards = (placement.place_rejections(asked, reports, k).select("seq", F.lit(k).cast("bigint").alias("copies"), "status")
                       for k in (st.COPIES, erasure.TOTAL_SHARDS))
    return chunks_.unionByName(shards)


@query("dfs_rereplicate_plan", stmt(FILES, REPLICAS, """
live AS (SELECT s_suppkey AS node, CAST(round(s_acctbal*100) AS BIGINT) AS free_space FROM supplier WHERE s_suppkey <> 3),
lost AS (SELECT filename, chunk_no, node AS dead_node FROM copies WHERE node = 3),
donors AS (SELECT filename, chunk_no, arg_min(node, rank) AS donor FROM copies WHERE node <> 3 GROUP BY ALL),
options AS (
  SELECT l.filename, l.chunk_no, l.dead_node, v.node AS target,
    row_number() OVER (PARTITION BY l.filename, l.chunk_no ORDER BY v.free_space DESC, v.node) AS place
  FROM lost l, live v WHERE NOT EXISTS (
    SELECT 1 FROM copies c WHERE c.filename = l.filename AND c.chunk_no = l.chunk_no AND c.node = v.node))""", body="""
SELECT filename, chunk_no, dead_node, donor, target FROM options JOIN donors USING (filename, chunk_no) WHERE place = 1"""))
def dfs_rereplicate_plan(spark: SparkSession, sf: str) -> DataFrame:
    nodes = st.nodes(spark, sf)
    return placement.rereplicate(st.replica_list(spark, sf), nodes, nodes.where(F.col("node") == 3).select("node"))


# ---- versions, registration, replica lists ------------------------------------------------------

_WRITES = """
writes AS (
  SELECT event_id AS seq, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS chunk,
    event_id // 4 + CAST(floor(value) AS BIGINT) AS write_ts FROM events),
judged AS (
  SELECT *, max(write_ts) OVER (PARTITION BY chunk ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known FROM writes),
versions AS (
  SELECT seq, chunk, write_ts, known IS NULL OR write_ts > known AS accepted,
    CAST(count(*) FILTER (known IS NULL OR write_ts > known) OVER (PARTITION BY chunk ORDER BY seq) AS BIGINT) AS version FROM judged)"""


@query("dfs_upsert_versions", stmt(_WRITES, body="SELECT seq, chunk, write_ts, accepted, version FROM versions"))
def dfs_upsert_versions(spark: SparkSession, sf: str) -> DataFrame:
    return running.newer_only(st.chunk_writes(spark, sf), "chunk", "seq", "write_ts", BLOCK)


@query("dfs_upsert_latest", stmt(_WRITES, body="""
SELECT chunk, max(version) AS version, max(write_ts) AS write_ts, max(seq) AS seq FROM versions WHERE accepted GROUP BY chunk"""))
def dfs_upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    return running.latest_version(st.chunk_writes(spark, sf), "chunk", "seq", "write_ts", BLOCK)


@query("dfs_register_status", stmt(TRAFFIC, body="""
SELECT seq, node, CAST(row_number() OVER (PARTITION BY node ORDER BY seq) = 1 AS BIGINT) AS status FROM hb"""))
def dfs_register_status(spark: SparkSession, sf: str) -> DataFrame:
    return running.first_per_key(st.heartbeats(spark, sf).select("seq", "node"), "node", "seq")


_MAP = stmt(EVENTS, """
folded AS (
  SELECT chunk, list_reduce(
    list_prepend({'seq': CAST(0 AS BIGINT), 'kind': '', 'nodes': CAST([] AS BIGINT[])}, steps),
    lambda acc, e: {'seq': e.seq, 'kind': '', 'nodes': CASE
      WHEN e.kind = 'store' THEN e.nodes
      WHEN e.kind = 'fixed' THEN CASE WHEN list_contains(acc.nodes, e.nodes[1]) THEN acc.nodes ELSE list_append(acc.nodes, e.nodes[1]) END
      WHEN e.kind = 'deleted' AND len(list_filter(acc.nodes, lambda x: x <> e.nodes[1])) > 0
        THEN list_append(list_filter(acc.nodes, lambda x: x <> e.nodes[1]), e.nodes[1])
      ELSE list_filter(acc.nodes, lambda x: x <> e.nodes[1]) END}) AS final FROM history)""", body="""
SELECT chunk, array_to_string(final.nodes, '-') AS nodes FROM folded""")


@query("dfs_replica_map", _MAP)
def dfs_replica_map(spark: SparkSession, sf: str) -> DataFrame:
    lists = replica_lists.replica_map(st.replica_events(spark, sf), BLOCK)
    return lists.select("chunk", F.array_join(F.col("nodes").cast("array<string>"), "-").alias("nodes"))


@query("hb_cadence_class", stmt(TRAFFIC, body="""
SELECT seq, node, CASE WHEN row_number() OVER (PARTITION BY node ORDER BY seq) % 10 = 0 THEN 'major' ELSE 'minor' END AS kind FROM hb"""))
def hb_cadence_class(spark: SparkSession, sf: str) -> DataFrame:
    return classified_heartbeats(spark, sf).select("seq", "node", "kind")


def classified_heartbeats(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth report of a node is a major one."""
    numbered = running.number_rows(st.heartbeats(spark, sf), "node", "seq", "turn", BLOCK)
    return numbered.withColumn("kind", F.when(F.col("turn") % 10 == 0, "major").otherwise("minor")).drop("turn")


# ---- erasure coding -----------------------------------------------------------------------------

@query("dfs_shard_checksums", stmt(FILES, SHARDS, body="SELECT filename, chunk_no, shard_no, sha1(data) AS sha1 FROM shards"))
def dfs_shard_checksums(spark: SparkSession, sf: str) -> DataFrame:
    return erasure.data_shards(st.file_chunks(spark, sf)).select("filename", "chunk_no", "shard_no", F.sha1("data").alias("sha1"))


@query("ec_data_shards", stmt(FILES, SHARDS, body="""
SELECT filename, chunk_no, shard_no, CAST(octet_length(data) AS BIGINT) AS n_bytes, sha1(data) AS sha1 FROM shards"""))
def ec_data_shards(spark: SparkSession, sf: str) -> DataFrame:
    return _digest(erasure.data_shards(st.file_chunks(spark, sf)), "filename", "chunk_no", "shard_no")


_PARITY = """
coefficients AS (
  SELECT * FROM (VALUES (7,1,7),(7,2,6),(7,3,5),(7,4,4),(7,5,3),(7,6,2), (8,1,6),(8,2,7),(8,3,4),(8,4,5),(8,5,2),(8,6,3),
    (9,1,160),(9,2,223),(9,3,223),(9,4,183),(9,5,254),(9,6,232)) AS t(parity, shard_no, c)),
doubled(parity, shard_no, k, v) AS (
  SELECT parity, shard_no, 0, c FROM coefficients
  UNION ALL SELECT parity, shard_no, k + 1, xor(v*2, CASE WHEN v >= 128 THEN 285 ELSE 0 END) FROM doubled WHERE k < 7),
products AS (
  SELECT parity, shard_no, CAST(b AS INT) AS b, bit_xor(CASE WHEN (b >> k) & 1 = 1 THEN v ELSE 0 END) AS v
  FROM doubled, unnest(range(0, 256)) AS t(b) GROUP BY 1, 2, 3),
texts AS (SELECT filename, chunk_no, shard_no, hex(data) AS h FROM shards),
bytes AS (
  SELECT filename, chunk_no, shard_no, i, CAST('0x' || substr(h, 2*i + 1, 2) AS INT) AS b FROM texts, unnest(range(0, length(h) // 2)) AS t(i)),
summed AS (SELECT filename, chunk_no, parity, i, bit_xor(v) AS v FROM bytes JOIN products USING (shard_no, b) GROUP BY ALL),
parities AS (SELECT filename, chunk_no, parity AS shard_no, unhex(string_agg(printf('%02X', v), '' ORDER BY i)) AS data FROM summed GROUP BY ALL)"""


@query("ec_encode", stmt(FILES, SHARDS, _PARITY, body="""
SELECT filename, chunk_no, CAST(shard_no AS BIGINT) AS shard_no, CAST(octet_length(data) AS BIGINT) AS n_bytes, sha1(data) AS sha1
FROM (SELECT filename, chunk_no, shard_no, data FROM shards UNION ALL SELECT filename, chunk_no, shard_no, data FROM parities)
""").replace("WITH ", "WITH RECURSIVE ", 1))
def ec_encode(spark: SparkSession, sf: str) -> DataFrame:
    return _digest(erasure.encode(st.file_chunks(spark, sf)), "filename", "chunk_no", "shard_no")


def _shard_digests(spark: SparkSession, sf: str) -> DataFrame:
    """What was recorded when the shards were written."""
    return erasure.encode(st.file_chunks(spark, sf)).select("filename", "chunk_no", "shard_no", F.sha1("data").alias("sha1"))


# Shards of the store by what is left of them: sound (a sound copy at least), single (all copies agree), wrong (altered, no other copy).
_HELD = """
held AS (
  SELECT filename, chunk_no, doc_id, any_value(data) AS data, count(*) FILTER (t <> 7) AS sound,
    count(*) FILTER (t NOT IN (0, 7)) AS single, count(*) FILTER (t = 7) AS wrong, max(s) FILTER (t = 7) AS wrong_shard
  FROM (SELECT *, (doc_id*5 + chunk_no + s) % 14 AS t FROM chunks, unnest(range(1, 10)) AS t(s)
        WHERE (s + doc_id + chunk_no) % 9 >= (doc_id*3 + chunk_no) % 5) GROUP BY filename, chunk_no, doc_id)"""


@query("ec_decode", stmt(FILES, _HELD, body="""
SELECT filename, chunk_no, CAST(octet_length(data) AS BIGINT) AS n_bytes, sha1(data) AS sha1,
  CASE WHEN doc_id % 3 <> 0 THEN 'digest' WHEN wrong = 0 THEN 'spare' ELSE 'located' END AS proof,
  CASE WHEN doc_id % 3 = 0 THEN wrong_shard END AS wrong_shard
FROM held WHERE CASE WHEN doc_id % 3 <> 0 THEN sound >= 6 WHEN wrong = 0 THEN single >= 7 ELSE single >= 7 END"""))
def ec_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Altered, lost and doubled shards; every third file's digests were never recorded. Unproven bytes are left out."""
    known = _shard_digests(spark, sf).where(F.substring_index("filename", "/", -1).cast("bigint") % 3 != 0)
    rebuilt = erasure.decode(st.shard_store(spark, sf), known).where("proof <> 'none'")
    return _digest(rebuilt, "filename", "chunk_no", "proof", "wrong_shard")


@query("ec_read_files", stmt(FILES, _HELD, """
broken AS (SELECT filename FROM chunks LEFT JOIN held USING (filename, chunk_no) WHERE coalesce(sound, 0) < 6)""", body=f"""
{_PARTS} WHERE filename NOT IN (SELECT filename FROM broken)"""))
def ec_read_files(spark: SparkSession, sf: str) -> DataFrame:
    rebuilt = erasure.decode(st.shard_store(spark, sf), _shard_digests(spark, sf))
    totals = chunks.numbers(st.files(spark, sf), st.CHUNK_BYTES).groupBy("filename").agg(F.count("*").alias("total_chunks"))
    return _digest(chunks.reassemble(rebuilt, totals), "filename", "part_no")


@query("ec_recoverability", stmt(FILES, _HELD, body="""
SELECT c.filename, c.chunk_no, coalesce(sound, 0) AS good_shards, coalesce(sound, 0) >= 6 AS recoverable
FROM chunks c LEFT JOIN held h ON h.filename = c.filename AND h.chunk_no = c.chunk_no"""))
def ec_recoverability(spark: SparkSession, sf: str) -> DataFrame:
    return erasure.scrubbed_recoverability(erasure.scrub(_shard_digests(spark, sf), st.shard_store(spark, sf)))


@query("ec_scrub_status", stmt(FILES, body="""
SELECT filename, chunk_no, s AS shard_no, CASE
    WHEN (s + doc_id + chunk_no) % 9 < (doc_id*3 + chunk_no) % 5 THEN 'missing'
    WHEN (doc_id*5 + chunk_no + s) % 14 = 7 THEN 'corrupt' ELSE 'healthy' END AS status
FROM chunks, unnest(range(1, 10)) AS t(s)"""))
def ec_scrub_status(spark: SparkSession, sf: str) -> DataFrame:
    return erasure.scrub(_shard_digests(spark, sf), st.shard_store(spark, sf))


@query("ec_node_inventory", stmt(FILES, """
held AS (
  SELECT (doc_id*7 + chunk_no*3 + s) % n AS node, octet_length(data) AS size FROM chunks, n, unnest(range(1, 10)) AS t(s))""", body="""
SELECT node, count(*) AS shards, CAST(sum((size + 9) // 6) AS BIGINT) AS shard_bytes FROM held GROUP BY node"""))
def ec_node_inventory(spark: SparkSession, sf: str) -> DataFrame:
    sizes = st.file_chunks(spark, sf).select("filename", "chunk_no", erasure.shard_bytes(F.length("data")).alias("size"))
    held = st.shard_list(spark, sf).join(sizes, ["filename", "chunk_no"])
    return held.groupBy("node").agg(F.count("*").alias("shards"), F.sum("size").cast("bigint").alias("shard_bytes"))
