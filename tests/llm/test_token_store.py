"""The token store on hot ids and its selective reads."""

import tempfile
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture()
def stored(spark):
    """4,000 rows: a third on one id with different texts, a third on the null id without a text."""
    from offerline.llm import common, token_store

    common.ship_package(spark)
    rows = spark.range(4000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 2, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 != 1, F.concat(F.lit("word "), F.col("id").cast("string"))).alias("text"))
    path = tempfile.mkdtemp(prefix="offerline-llm-tokens-") + "/store"
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        token_store.write_tokens(rows, path, tokenizer, 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return rows, path, tokenizer


def test_hot_ids_are_dealt(spark, stored):
    from offerline.llm import token_store
    from offerline.llm.tokens import encoder

    rows, path, tokenizer = stored
    per_part = [r["count"] for r in spark.read.parquet(f"{path}/tokens").groupBy("part").count().collect()]
    assert len(per_part) > 4 and max(per_part) <= 2 * sum(per_part) / len(per_part)

    got = sorted(token_store.checksums(token_store.read_tokens(spark, path)).collect(), key=lambda r: r["start"])
    ends = np.cumsum([r["n_tokens"] for r in got])
    assert [r["start"] for r in got] == [0, *ends[:-1].tolist()]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids)

    source = rows.collect()
    want = sorted((-1 if r["doc_id"] is None else r["doc_id"], zlib.crc32(np.append(x, np.uint32(1)).astype("<u4").tobytes()))
                  for r, x in zip(source, encoder(tokenizer).encode([r["text"] or "" for r in source])))
    assert sorted(zip(ids, (r["ids_crc32"] for r in got))) == want


def test_metadata_reads_touch_no_tokens(spark, stored):
    from offerline.llm import token_store

    _, path, _ = stored
    plan = token_store.read_tokens(spark, path, ids=False)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in [c.split(":")[0] for line in plan.splitlines() if "ReadSchema" in line
                         for c in line.split("ReadSchema: struct<")[1].rstrip(">").split(",")]
    one = token_store.read_tokens(spark, path).filter(F.col("doc_id") == 2000)
    assert "EqualTo(doc_id,2000)" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1
    for file in spark.read.parquet(f"{path}/tokens").inputFiles():
        meta = pq.ParquetFile(file.removeprefix("file://")).metadata
        for group in range(meta.num_row_groups):
            columns = {meta.row_group(group).column(i).path_in_schema.split(".")[0]: meta.row_group(group).column(i) for i in range(meta.num_columns)}
            assert all(c.has_column_index and c.has_offset_index for c in columns.values())
            assert "DELTA_BINARY_PACKED" in columns["n_tokens"].encodings and any("DICTIONARY" in e for e in columns["ids"].encodings)
