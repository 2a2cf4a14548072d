"""Benchmark decontamination by template windows, with DataFrame operations only.

Numbers, names and units become typed placeholders, so a question asked again with other values has the
template of the first. Words are typed one by one, whatever white space is between them: every word that begins with
a capital may be a name, also at the start of a sentence. An item's window is looked up with each of its possible
names as a placeholder and as the lower-case word, a document's with all as placeholders and with all as words,
so a verbatim passage is found however it is spelt or broken into lines. Windows of five words are hash-joined. A document is
contaminated by an item if it has most of the item's windows and the values in its slots are consistent:
the same value of the item always became the same value of the document. Only placeholders are compared, each
place of the item once. A long run of windows that are the item's word for word counts whatever its share of the
item, and so does a whole item that has hardly any words but placeholders. Items shorter than a window are looked up as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.common import query, table
from holdfast.session import staged

WIDTH = 5
COVERAGE = 0.8
CONSISTENCY = 0.8
LITERALS = 2
#: Consecutive windows, word for word, that are enough on their own.
RUN = 13
#: Items of so many words are found anywhere in a document; shorter ones only if they are all of it.
SHORT = 3
BROADCAST_ROWS = 500_000

# Units that become a placeholder after a number.
UNITS = (
    "kg|g|mg|lb|lbs|km|m|cm|mm|mi|miles?|met(?:er|re)s?|feet|ft|inch(?:es)?|l|ml|lit(?:er|re)s?|hours?|h|minutes?|min|"
    "seconds?|s|days?|weeks?|months?|years?|usd|eur|dollars?|euros?|cents?|percent|degrees?|mph|kmh|watts?|volts?"
)
NUMBER = r"(?<![\p{L}\p{N}])[0-9]+(?:[.,:/][0-9]+)*"
NAME = r"(?<![\p{L}\p{N}#])\p{Lu}[\p{L}'-]*"
TRAILING = r"(?<=[\p{L}\p{N}])[.,;:!?]+(?=\s|$)"
SPACES = r"[\x20\x09-\x0D]+"


def _split(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def typed_words(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and four lists of the words of ``text``, without what ends a sentence or a clause behind them.

    ``_r`` has them as they are, ``_v`` in lower case; ``_l`` has numbers as ``#n`` and units after numbers as ``#u``
    besides; ``_t`` has possible names as ``#p`` too.
    """
    clean = df.select(*keys, F.regexp_replace("text", TRAILING, "").alias("_c"))
    numbered = clean.select(*keys, "_c", F.regexp_replace(
        F.regexp_replace("_c", NUMBER, "#n"), rf"(?i)(?<=#n)(\s*)(?:{UNITS})(?![\p{{L}}\p{{N}}])", "$1#u").alias("_n"))
    return numbered.select(
        *keys, _split(F.col("_c")).alias("_r"), _split(F.lower("_c")).alias("_v"), _split(F.lower("_n")).alias("_l"),
        _split(F.lower(F.regexp_replace("_n", NAME, "#p"))).alias("_t"))


def _starts(width: int) -> Column:
    return F.when(F.size("_t") >= width, F.sequence(F.lit(1), F.size("_t") - width + 1)).otherwise(F.array().cast("array<int>"))


def _hash(words: str, at: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(words, at + (j - 1)) for j in range(width)])


def windows(df: DataFrame, keys: list[str], width: int = WIDTH) -> DataFrame:
    """``keys`` and ``at, h`` for each window, once for each of its spellings: with all placeholders, without names, word for word.

    Generators without a lambda keep this in compiled code up to the join; outer ones add no filter that would
    type the words again.
    """
    placed = typed_words(df, keys).select(*keys, "_t", "_l", "_v", F.explode_outer(_starts(width)).alias("at")).where("at is not null")
    each = F.array_distinct(F.array(*[_hash(words, F.col("at"), width) for words in ("_t", "_l", "_v")]))
    return placed.select(*keys, "at", F.explode_outer(each).alias("h"))


def _items(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null and item_id is not null")
    return typed_words(items, ["item_id"])


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(h, item_id, window, item_at, item_slots, n_windows, places, n_places)``: what an item's windows may look like.

    Each of an item's different windows stands at its first place: ``window`` is the first place with the same
    template, ``h`` the hash of one spelling: each possible name as a placeholder or as the word. Spellings with
    fewer than LITERALS words that are no placeholder say nothing, so their ``window`` is null. ``item_slots`` has
    the words that are placeholders in the template, and null for the others. ``places`` has all places where ``h``
    is the item word for word, if any, of the ``n_places`` that the item has.
    """
    typed = _items(benchmark)
    placed = typed.select("item_id", "_t", "_l", "_r", "_v", F.explode(_starts(width)).alias("at")).select(
        "item_id", "at", *[F.slice(c, F.col("at"), width).alias(c) for c in ("_t", "_l", "_r", "_v")])
    spelt = placed.withColumn("s", F.array(F.array().cast("array<string>")))
    for j in range(width):  # after each word, all different spellings so far
        both = F.array_distinct(F.array(F.col("_t")[j], F.col("_l")[j]))
        spelt = spelt.select("item_id", "at", "_t", "_l", "_r", F.explode("s").alias("p"), both.alias("b")).select(
            "item_id", "at", "_t", "_l", "_r", F.transform("b", lambda w: F.concat("p", F.array(w))).alias("s"))
    literals = F.size(F.filter("p", lambda w: ~w.startswith("#")))
    rows = spelt.select("item_id", "at", "_t", "_r", F.explode("s").alias("p")).where(literals >= LITERALS).select(
        "item_id", "at", _hash("p", F.lit(1), width).alias("h"), F.xxhash64("_t").alias("t"),
        F.when(F.exists("_t", lambda w: w.startswith("#")), F.zip_with("_t", "_r", lambda t, r: F.when(t.startswith("#"), r))).alias("slots"))
    first = rows.withColumn("window", F.min("at").over(Window.partitionBy("item_id", "t"))).groupBy("item_id", "h").agg(
        F.min_by("window", "at").alias("window"), F.min("at").alias("item_at"), F.min_by("slots", "at").alias("item_slots"))
    counts = first.groupBy("item_id").agg(F.count_distinct("window").alias("n_windows"))
    same = placed.groupBy("item_id", _hash("_v", F.lit(1), width).alias("h")).agg(F.collect_set("at").alias("places"))
    sizes = typed.where(F.size("_v") >= width).groupBy("item_id").agg((F.max(F.size("_v")) - width + 1).alias("n_places"))
    every = first.join(same, ["item_id", "h"], "full").join(sizes, "item_id").join(counts, "item_id", "left")
    return every.select("h", "item_id", "window", "item_at", "item_slots", F.coalesce("n_windows", F.lit(0)).alias("n_windows"), "places", "n_places")


def _held_runs(hits: DataFrame, pair: list[str], run: int) -> DataFrame:
    """``pair`` of documents and items with ``run`` consecutive windows word for word, or with all of a shorter item."""
    lined = hits.where("places is not null").select(*pair, "at", "n_places", F.explode("places").alias("place")).distinct()
    shift = (F.col("at") - F.col("place")).alias("shift")
    island = F.col("at") - F.row_number().over(Window.partitionBy(*pair, "shift").orderBy("at"))
    runs = lined.select(*pair, "at", "n_places", shift).withColumn("island", island).groupBy(*pair, "shift", "island").agg(
        F.count("*").alias("n"), F.first("n_places").alias("n_places"))
    return runs.where(F.col("n") >= F.least(F.lit(run), F.col("n_places"))).select(*pair).distinct()


def _short_items(texts: DataFrame, benchmark: DataFrame, width: int, broadcast_rows: int) -> DataFrame | None:
    """``(doc_id, copy, item_id)`` for items of fewer than ``width`` words; None if there are none."""
    short = staged(_items(benchmark).where((F.size("_v") > 0) & (F.size("_v") < width)).select(
        "item_id", F.size("_v").alias("words"), F.concat_ws(" ", "_v").alias("line")), "short-items")
    found = None
    for (words,) in short.select("words").distinct().orderBy("words").collect():
        mine = short.where(F.col("words") == words).select("line", "item_id")
        mine = F.broadcast(mine) if short.count() <= broadcast_rows else mine
        typed = typed_words(texts, ["doc_id", "copy"]).where(F.size("_v") >= words if words >= SHORT else F.size("_v") == words)
        starts = F.sequence(F.lit(1), F.size("_v") - words + 1)
        lines = typed.select("doc_id", "copy", F.explode(F.transform(starts, lambda i: F.concat_ws(" ", F.slice("_v", i, words)))).alias("line"))
        hits = lines.join(mine, "line").select("doc_id", "copy", "item_id").distinct()
        found = hits if found is None else found.unionByName(hits)
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, coverage: float = COVERAGE,
                 consistency: float = CONSISTENCY, broadcast_rows: int = BROADCAST_ROWS, run: int = RUN) -> DataFrame:
    """``(doc_id, item_id, n_windows, n_found, coverage, n_slots, consistency, kind)`` of contaminated documents.

    ``kind`` is ``verbatim`` if no slot changed, else ``reworked``. Null and empty texts match nothing. ``run``
    consecutive windows word for word, or all windows of an item with fewer, are a copy whatever the share and the
    slots. Items of fewer than ``width`` words match word for word: anywhere from SHORT words on, below that only
    a document that is nothing else; they count as one window. Rows that repeat a doc_id with another text count on their own
    and give a row each if they are contaminated; identical rows give one. Rows without a doc_id are left out.

    The benchmark's windows are broadcast while there are at most ``broadcast_rows`` of them; beyond that
    Spark chooses how to join.

    ``n_slots`` counts the item's places with a placeholder that were found, and ``consistency`` is that of its worst
    value: the share of the value's places where it became what it most often became. Where several places of
    the document match one of the item, the one counts whose shift against the item most windows have. Copies that
    have enough windows under one shift are judged on their own as well, and the most consistent one counts.
    """
    known = staged(benchmark_windows(benchmark, width), "benchmark-windows")
    if known.count() <= broadcast_rows:
        known = F.broadcast(known)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null and doc_id is not null")
    hits = windows(texts.withColumn("copy", F.xxhash64("text")), ["doc_id", "copy"], width).join(known, "h")
    pair = ["doc_id", "copy", "item_id"]
    hits = staged(hits.select(*pair, "at", "window", "item_at", "item_slots", "n_windows", "places", "n_places"), "benchmark-hits")
    counted = hits.groupBy(*pair).agg(F.count_distinct("window").alias("n_found"), F.first("n_windows").alias("n_windows"))
    runs = staged(_held_runs(hits, pair, run).join(counted, pair), "runs")
    hits = hits.where("window is not null")
    kept = staged(counted.where((F.col("n_windows") > 0) & (F.col("n_found") >= coverage * F.col("n_windows"))), "contaminated")
    shift = F.col("at") - F.col("item_at")
    like = F.size(F.collect_set("window").over(Window.partitionBy(*pair, shift)))
    whole = F.when(F.col("like") >= coverage * F.col("n_windows"), F.array(shift, F.lit(None))).otherwise(F.array(F.lit(None).cast("int")))
    held = texts.withColumn("copy", F.xxhash64("text")).join(kept.select(*pair[:2]).distinct(), pair[:2], "left_semi").dropDuplicates(pair[:2])
    raw = typed_words(held, pair[:2]).select(*pair[:2], "_r")
    lined = hits.join(kept.select(*pair), pair).withColumn("like", like).where("item_slots is not null").join(raw, pair[:2]).select(
        *pair, "like", "at", "n_windows", "item_at", "item_slots", F.slice("_r", F.col("at"), width).alias("slots"))
    words = lined.select(*pair, "like", "at", "item_at", "slots", "item_slots", F.explode(whole).alias("shift")).select(
        "*", F.posexplode("item_slots").alias("i", "old")).where("old is not null")
    one = [*pair, "shift"]
    places = words.groupBy(*one, (F.col("item_at") + F.col("i")).alias("place")).agg(F.max(F.struct(
        "like", -F.col("at"), F.lower("old").alias("old"), F.lower(F.get("slots", F.col("i"))).alias("new"))).alias("v"))
    values = places.groupBy(*one, F.col("v.old").alias("old"), F.col("v.new").alias("new")).count()
    agreed = values.groupBy(*one, "old").agg(
        F.max("count").alias("most"), F.sum("count").alias("n"),
        F.max(F.when(F.col("old") == F.col("new"), 0).otherwise(1)).alias("changed"))
    judged = agreed.groupBy(*one).agg(
        F.min(F.col("most") / F.col("n")).alias("consistency"), (1 - F.max("changed")).alias("same"), F.sum("n").alias("n_slots"))
    best = judged.groupBy(*pair).agg(F.max(F.struct("consistency", "same", "n_slots")).alias("b")).select(*pair, "b.*")
    judged = kept.join(best, pair, "left").select(
        *pair, "n_windows", "n_found", F.coalesce("n_slots", F.lit(0)).alias("n_slots"), F.coalesce("consistency", F.lit(1.0)).alias("consistency"),
        F.when(F.coalesce("same", F.lit(1)) == 0, "reworked").otherwise("verbatim").alias("kind")).where(F.col("consistency") >= consistency)
    plain = [F.lit(0).cast("long").alias("n_slots"), F.lit(1.0).alias("consistency"), F.lit("verbatim").alias("kind")]
    found = judged.unionByName(runs.join(judged.select(*pair), pair, "left_anti").select(*pair, "n_windows", "n_found", *plain))
    short = _short_items(texts.withColumn("copy", F.xxhash64("text")), benchmark, width, broadcast_rows)
    if short is not None:
        one = F.lit(1).cast("long")
        found = found.unionByName(short.select(*pair, one.alias("n_windows"), one.alias("n_found"), *plain))
    share = F.coalesce(F.col("n_found") / F.when(F.col("n_windows") > 0, F.col("n_windows")), F.lit(1.0))
    return found.select("doc_id", "item_id", "n_windows", "n_found", share.alias("coverage"), "n_slots", "consistency", "kind")


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
