"""A training-corpus pipeline of five of the operators over ``documents``.

Each stage reads its predecessor's stored rows, keeps the columns of
documents (the last returns packed pieces and sequences) and drops what it decides to drop:

1. quality: documents that the nearest-neighbour classifier rejects go;
2. near-duplicates: one document of each SimHash component stays;
3. repeats: bytes that a smaller document id also holds go;
4. benchmark: documents with a benchmark passage go;
5. packing: what is left, cut and packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerline.llm import common, decontaminate, packing, quality_knn, simhash, suffix_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
KEEP_FROM = 0.7
NO_ID = 1 << 62     # rows without an id are numbered from here while groups are formed


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Scores as the quality query has them; those under the threshold go.
    Without a labelled document to learn from all stay."""
    labels = common.table(spark, sf_dir, "labels")
    space = quality_knn.fit(docs, labels, common.id_crc_mod("doc_id", 4) != 2)
    if space is None:
        return docs.select(*COLUMNS)
    return quality_knn.scores(docs, space, carry=COLUMNS).filter(F.col("score") >= KEEP_FROM).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays, that of the smallest id; where the
    component holds an id with several texts, one of them by their hash. A row
    without an id counts behind all others, equal texts without one as one
    document."""
    docs = docs.withColumns({"doc_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID) + F.pmod(F.xxhash64("text"), F.lit(1 << 61))),
                             "key": F.xxhash64("text")})
    first = simhash.representatives(docs, "key").withColumnRenamed("id", "doc_id")
    kept = docs.join(first, ["doc_id", "key"], "left_semi")
    twice = kept.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id", "key")
    # Repeated rows are rare: only they are sorted out.
    again = kept.join(twice, ["doc_id", "key"], "left_semi").groupBy("doc_id", "key").agg(F.min(F.struct(
        *[F.col(c) for c in COLUMNS[1:]])).alias("r")).select("doc_id", "r.*")
    one = kept.join(twice, ["doc_id", "key"], "left_anti").select(*COLUMNS).unionByName(again)
    return one.withColumn("doc_id", F.when(F.col("doc_id") < NO_ID, F.col("doc_id")))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text without repeated bytes; a character that lost some of its
    bytes goes whole. Documents of which nothing is left go."""
    cleaned = suffix_dedup.dedup(docs, carry=("lang", "source")).filter(
        (F.col("n_removed") == 0) | (F.length("kept") > 0))
    return cleaned.select(F.col("id").alias("doc_id"), F.col("kept").alias("text"), "lang", "source",
                          F.length("kept").cast("long").alias("n_chars"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window stay."""
    found = decontaminate.decontaminate(docs, common.table(spark, sf_dir, "benchmark"), carry=COLUMNS)
    return found.filter(F.size("hits") == 0).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece of the packed sequences; a sequence's first piece
    (offset 0) holds the padded ids of the whole of it."""
    return packing.read_back(packing.sequences(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))), whole=True)


def _stage(fn):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.ship_package(spark)
        return fn(spark, docs, sf_dir)
    return run_stage


STAGES = [("quality_classifier", _stage(quality)), ("simhash_near_dedup", _stage(near_duplicates)),
          ("suffix_array_dedup", _stage(repeats)), ("benchmark_decontamination", _stage(benchmark)), ("packing", _stage(packed))]
ORACLE_SQL = None   # hashing, ranking and packing have no SQL; tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
