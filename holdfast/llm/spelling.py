"""Spelling variant grouping: words one edit apart, found by dense prefix and suffix tiles.

Two words are one edit apart if their common prefix and common suffix together reach the longer length
minus one. Words meet only under a shared key, which is the word without a window of two code points, so a
group has at most the words that differ inside that window; tiles of padded code-point matrices then
compare each group in full.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import map_rows, query, table
from holdfast.session import drop_path, fresh_path

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST = 7
FEWEST = 2
RATIO = 10
NOISE = 31
#: Code points a key leaves out, and the most keys of a word for each length; longer words leave out more.
WINDOW = 2
MOST_WINDOWS = 32
#: Words on a side of a tile, and code points compared at once.
BLOCK = 64
CELLS = 4 << 20
#: Different words a task holds before it hands on their counts.
HELD_WORDS = 200_000

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def noisy(doc_id: int | None, run: str, noise: int = NOISE) -> str:
    """``run`` as it counts: without one code point where the checksum of document and run says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode("utf-8", "surrogatepass"))
    if h % noise:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, shortest: int = SHORTEST, noise: int = NOISE, held: int = HELD_WORDS) -> DataFrame:
    """``(word, n)``: the words of every whole text of ``docs`` with at least ``shortest`` code points, counted once.

    A word is a maximal run of letters, A-Z lower-cased, with the deletions of ``noisy``. Each task adds up
    its own words, at most ``held`` at a time, before they are shuffled. A null or empty text has no words;
    a missing doc_id counts as empty text in the checksum; rows that repeat count each; other columns are not read.
    """
    runs = re.compile(f"[{LETTERS}]{{{shortest},}}")

    def run(rows):
        seen: Counter = Counter()
        for doc_id, text in rows:
            mine: Counter = Counter()
            for raw, times in Counter(runs.findall(text or "")).items():
                mine[raw.translate(_LOWER)] += times
            for word, times in mine.items():
                kept = noisy(doc_id, word, noise)
                if len(kept) >= shortest:
                    seen[kept] += times
            if len(seen) >= held:
                yield from seen.items()
                seen = Counter()
        yield from seen.items()

    found = map_rows(docs.select(F.col("doc_id").cast("long"), "text"), "word string, n bigint", run, chunk=10_000)
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def window_width(length: Column) -> Column:
    return F.greatest(F.lit(WINDOW), F.ceil(length / MOST_WINDOWS).cast("int"))


def _keyed(words: DataFrame) -> DataFrame:
    """Each word under its keys as the longer and as the shorter word of a pair: ``(length, window, key, word, n)``.

    ``length`` is the longer length of the pairs looked for. If the edit falls into a window, the code points
    before it and behind it are the same in both words, counted from the start and from the end.
    """
    lengths = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("length"))
    width = window_width(F.col("length"))
    last = F.ceil(F.col("length") / width).cast("int") - 1
    slots = lengths.withColumn("width", width).select("*", F.explode(F.sequence(F.lit(0), last)).alias("window"))
    start = F.col("window") * F.col("width")
    behind = F.greatest(F.col("length") - start - F.col("width"), F.lit(0))
    head = F.col("word").substr(F.lit(1), start)
    tail = F.col("word").substr(F.length("word") - behind + 1, behind)
    return slots.select("length", "window", F.xxhash64(head, tail).alias("key"), "word", "n")


def _matrix(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, padded with zeros behind and before; one row beyond the words is all zeros."""

    def points(lines):
        whole = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(lines), width)
        return whole.astype(np.uint8) if whole.size and whole.max() < 256 else whole

    blank = "\0" * width
    return points([w.ljust(width, "\0") for w in words] + [blank]), points([w.rjust(width, "\0") for w in words] + [blank])


def _tile(fore, aft, short, rows, columns, window, width, length):
    """Which rows and columns of each tile are one edit apart, with the edit inside the group's window.

    ``rows`` and ``columns`` are ``(tiles, side)`` arrays of word numbers, -1 where a tile has no word.
    The edit's place is the length of the common prefix, which gives every pair exactly one window.
    """
    prefix = (fore[rows][:, :, None, :] == fore[columns][:, None, :, :]).argmin(-1)
    suffix = (aft[rows][:, :, None, ::-1] == aft[columns][:, None, :, ::-1]).argmin(-1)
    near = (prefix + suffix >= length - 1) & (prefix // width == window[:, None, None])
    near &= (rows[:, :, None] != columns[:, None, :]) & (rows[:, :, None] >= 0) & (columns[:, None, :] >= 0)
    return near & ~(short[rows][:, :, None] & short[columns][:, None, :])


def _compare(words: list[str], length: int, starts: np.ndarray, sizes: np.ndarray, windows: np.ndarray):
    """Neighbours of each word within its group, and its first neighbour there; groups of one longer length."""
    width = max(WINDOW, -(-length // MOST_WINDOWS))
    fore, aft = _matrix(words, length)
    short = np.array([len(w) < length for w in words] + [False])
    count = np.zeros(len(words), np.int64)
    best = np.full(len(words), len(words), np.int64)
    widest = max(1, min(BLOCK, int((CELLS // max(length, 1)) ** 0.5)))

    def take(rows, columns, window):
        near = _tile(fore, aft, short, rows, columns, window, width, length)
        found = near.sum(-1)
        hit = found > 0
        np.add.at(count, rows[hit], found[hit])
        first = np.take_along_axis(columns, near.argmax(-1), 1)
        np.minimum.at(best, rows[hit], first[hit])

    side = 2
    done = np.zeros(len(sizes), bool)
    while side <= widest:  # whole groups, several at once, padded to one size
        fits = np.flatnonzero(~done & (sizes <= side))
        done[fits] = True
        at_once = max(1, CELLS // (side * side * length))
        for i in range(0, len(fits), at_once):
            some = fits[i:i + at_once]
            grid = starts[some][:, None] + np.arange(side)
            grid[np.arange(side) >= sizes[some][:, None]] = -1
            take(grid, grid, windows[some])
        side *= 2
    for g in np.flatnonzero(~done):  # one group in pairs of blocks
        members = np.full(-(-sizes[g] // widest) * widest, -1)
        members[:sizes[g]] = starts[g] + np.arange(sizes[g])
        blocks = members.reshape(-1, widest)
        for rows in blocks:
            for columns in blocks:
                take(rows[None], columns[None], windows[g:g + 1])
    return count, best


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])


def _compare_groups(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, and within a group by falling count and then word."""
    length, window, key = (rows.column(c).to_numpy() for c in ("length", "window", "key"))
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (window[1:] != window[:-1]) | (length[1:] != length[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(key)))
    group = np.repeat(np.arange(len(starts)), sizes)
    for one in np.unique(length[starts[sizes > 1]]):
        chosen = (sizes > 1) & (length[starts] == one)
        at = np.flatnonzero(chosen[group])
        part = rows.take(pa.array(at))
        words = part.column("word").to_pylist()
        ends = np.cumsum(sizes[chosen])
        count, best = _compare(words, int(one), ends - sizes[chosen], sizes[chosen], window[starts[chosen]])
        hit = np.flatnonzero(count)
        mine, other = part.take(pa.array(hit)), part.take(pa.array(best[hit]))
        table_ = pa.table([mine.column("word"), pa.array(count[hit]), other.column("n"), other.column("word")], schema=_FOUND)
        yield from table_.to_batches(max_chunksize=10_000)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]).combine_chunks() if held is not None else rows
        length, window, key = (rows.column(c).to_numpy() for c in ("length", "window", "key"))
        same = (key == key[-1]) & (window == window[-1]) & (length == length[-1])
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield from _compare_groups(rows.slice(0, cut))
        held = rows.slice(cut)
    if held is not None:
        yield from _compare_groups(held)


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, near_n, near)`` for every word of ``words`` that has another one edit away.

    ``words`` has distinct, non-null ``word`` and its count ``n``. ``near`` is the neighbour with the largest
    count, the smallest in code-point order if there are several, and ``near_n`` its count. A group under one
    key holds words that differ in at most ``WINDOW`` code points: for 90 letters at most 8,190 words, however
    long the list. Words beyond 64 code points leave out more than two.
    """
    key = ["length", "window", "key"]
    sorted_rows = _keyed(words).repartition(*key).sortWithinPartitions(*key, F.desc("n"), "word")
    found = sorted_rows.mapInArrow(_neighbours, "word string, n_near bigint, near_n bigint, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.order")).alias("near_n"), F.col("best.near").alias("near"))


def follow(links: DataFrame) -> DataFrame:
    """``(word, root)``: where the chain from each ``word`` over ``form`` ends; ``links`` must have no circle.

    Every round doubles the reach, so a chain of 18 steps takes five rounds. Superseded rounds are removed.
    """
    spark = links.sparkSession
    schema = "word string, root string"
    path = fresh_path(spark, "roots")
    links.select("word", F.col("form").alias("root")).write.parquet(path)
    while True:
        now = spark.read.schema(schema).parquet(path)
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        if step.where("next is not null").isEmpty():
            return now
        following = fresh_path(spark, "roots")
        step.drop("next").write.parquet(following)
        drop_path(spark, path)
        path = following


def variant_groups(counts: DataFrame, ratio: int = RATIO, fewest: int = FEWEST) -> DataFrame:
    """Each word's form, root and neighbours: ``word, form, root, n, n_near, form_n``.

    ``counts`` has ``word`` and ``n``; rows that repeat a word are added up, null words are left out, words
    counted less than ``fewest`` times take no part, and no rows give no rows. The form is the near word of
    largest count (ties: smallest in code-point order) if that is at least ``ratio`` (2 or more) times the
    word's own; the root is the last form along the chain, the word itself if it has no form.
    """
    spark = counts.sparkSession
    clean = counts.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)
    path = fresh_path(spark, "words")
    clean.write.parquet(path)
    words = spark.read.schema(clean.schema).parquet(path)
    near = near_words(words)
    chosen = F.col("near_n") >= ratio * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("near")).alias("form"), F.when(chosen, F.col("near_n")).alias("form_n"))
    formed_path = fresh_path(spark, "forms")
    formed.write.parquet(formed_path)
    formed = spark.read.schema(formed.schema).parquet(formed_path)
    drop_path(spark, path)
    roots = follow(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(i))),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{7,}')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, 2*i + 1, 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc FROM counted, crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN crc % 31 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, unnest(range(0, length(word))) AS r(i)),
near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word),
ranked AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS place FROM near JOIN words o ON o.word = other),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10*w.n THEN other END AS form, CASE WHEN other_n >= 10*w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON r.word = w.word),
chain(word, root, step) AS (
  SELECT word, word, 0 FROM formed UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, form, (SELECT arg_max(c.root, c.step) FROM chain c WHERE c.word = f.word) AS root, n, n_near, form_n FROM formed f"""


@query("op13_spelling_variants", _SQL)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(word_counts(table(spark, sf_dir, "documents")))
