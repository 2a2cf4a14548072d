"""From documents to packed training sequences: five stages, each an operator of ``holdfast.llm``.

Every stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet in the shared folder and
reread as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import decontaminate, packing, quality, simhash, substrings
from holdfast.llm.common import query, table
from holdfast.session import fresh_path, scratch


#: Written times keep their microseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _row(docs: DataFrame, columns: list[str]):
    return F.struct(*[F.col(f"`{c}`") for c in columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Every row is judged by its text alone: null texts as empty ones, repeated rows each, rows without doc_id too.
    """
    model = quality.trained_on_folds(spark, sf_dir)
    return docs.where(quality.quality_score(spark, model)(F.col("text")) >= quality.THRESHOLD)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: three-word shingles, fingerprints within two bits.

    The smallest doc_id stays; rows without one are judged too and come last. Rows alike in doc_id and text count
    once; of different texts under one doc_id each is judged as a document. Null and empty texts are one group.
    """
    return simhash.first_of_each_group(docs)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the byte strings that an earlier one has; a character cut in two goes whole.

    All rows stay. ``n_chars`` follows the text. A null text comes back empty. Rows without doc_id come after all
    others; rows that share one never cut each other.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    schema = docs.select(*[F.col(f"`{c}`") for c in others]).schema
    told = F.to_json(_row(docs, others), _JSON) if others else F.lit("{}")
    cut = substrings.remove_repeats(docs.select("doc_id", "text", told.alias("others")), extra="others", keep="text")
    back = cut.select("doc_id", F.col("kept").cast("string").alias("text"), F.from_json("extra", schema, _JSON).alias("o"))
    full = back.select("doc_id", "text", *[F.col("o").getField(c).alias(c) for c in others])
    if "n_chars" in others:
        full = full.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType))
    return full.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it is or with other values.

    Rows are known by a hash of doc_id and text, so those that repeat a doc_id or have none are judged by their
    own text. Null and empty texts stay.
    """
    key = F.xxhash64("doc_id", "text")
    found = decontaminate.contaminated(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    keyed = docs.select(key.alias("key"), _row(docs, docs.columns).alias("row"))
    return keyed.join(found.select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti").select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences; a null text is its end token alone, repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", keep_one_of_each_group),
    ("suffix_dedup", cut_repeated_strings),
    ("decontaminate", drop_contaminated),
    ("pack", pack_sequences),
]

#: Trained models and suffix arrays have no SQL twin.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage stages is removed once its output is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
