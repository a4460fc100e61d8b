"""The registered queries of the operators."""

from __future__ import annotations

import functools
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerline.llm import (chat_tree, common, conversation_trie, decontaminate, langid, license_scan, ngram_lm, packing, quality_knn, rules, simhash,
                           source_audit, suffix_dedup, token_store)

from offerline.llm.oracles import OP11, OP13


def op1_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.scores(common.table(spark, sf_dir, "documents"), common.id_crc_mod("doc_id", 7) != 2).withColumnRenamed("id", "doc_id")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(common.table(spark, sf_dir, "documents"), texts=False).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_chat_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"))
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    convs = chat_tree.conversations(rows)
    return chat_tree.read_back(convs, chat_tree.nodes(convs, tokenizer), tokenizer)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.read_back(packing.sequences(packed))


def op5_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    space = quality_knn.fit(docs, common.table(spark, sf_dir, "labels"), common.id_crc_mod("doc_id", 4) != 2)
    return quality_knn.scores(docs, space).select(
        F.col("id").alias("doc_id"), (common.id_crc_mod("id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = rules.learn(rules.labelled(docs, common.table(spark, sf_dir, "labels")))
    failed = rules.base_failed()
    return rules.statistics(docs).select(
        "doc_id", "stats.n_words", "stats.word_chars", "stats.n_symbols", "stats.n_dup_lines", "stats.n_repeat_words",
        failed.alias("base_failed"), (~failed & rules.verdict(learned)).alias("kept"))


def op7_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = langid.train(docs, common.id_crc_mod("doc_id", 3) != 1)
    return langid.identify(docs, model).select(
        F.col("id").alias("doc_id"), (common.id_crc_mod("id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    n_hit = F.size("hits").cast("long")
    return found.select(F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{common.shared_dir(spark).rstrip('/')}/llm-tokens-{uuid.uuid4().hex}"
    token_store.write_tokens(common.table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), 1)
    return token_store.checksums(token_store.read_tokens(spark, path))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = conversation_trie.turns(common.table(spark, sf_dir, "conversations"))
    nodes, ends = conversation_trie.trie(*conversation_trie.rebuilt(numbered))
    none = F.sha2(F.lit("").cast("binary"), 256)
    return nodes.join(conversation_trie.ends_digest(ends), "node", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.transform(F.filter("places", lambda x: x["base"]), lambda x: x["word"])
    joined = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.transform(xs, lambda x: x["label"]))), ",")
    return license_scan.scan(common.table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(base).cast("long").alias("first_word"),
        F.array_max(base).cast("long").alias("last_word"), joined(F.filter("places", lambda x: x["base"])).alias("base_labels"),
        joined(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda x: x["share"])), F.lit(0.0)).alias("score"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, terms = source_audit.audit(common.table(spark, sf_dir, "documents"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "other"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", rank.alias("rank")).unionByName(
        terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))


def _shipped(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        common.ship_package(spark)
        return fn(spark, sf_dir)
    return run


QUERIES = {f.__name__: _shipped(f) for f in (op1_ngram_lm, op2_suffix_dedup, op3_chat_prefix_tree, op4_packing, op5_quality_knn, op6_quality_rules, op7_language_ppm,
                                   op8_decontaminate, op9_simhash, op10_token_store, op11_conversation_trie, op12_license_scan, op13_source_audit)}
ORACLES: dict[str, str] = {"op11_conversation_trie": OP11, "op13_source_audit": OP13}
