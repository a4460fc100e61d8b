"""Token ids as Parquet: one row a document, ids in a list column.

Documents are placed by id range and sorted, so the files together are in
ascending id order and page statistics on the id let a reader skip pages.
The list column is dictionary encoded (a vocabulary fits the dictionary), the
id, count and offset columns delta encoded; row groups and pages are of fixed
size and carry a page index. A second small table holds one row per part:
its first id, its token count and the tokens before it. Reading metadata
touches no token page; reading a range of ids touches its pages only.

Rows: a null or empty text holds the end id alone; repeated ids are ordered
by their texts' first 32 characters, then by hash, and kept; an empty table gives empty files.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerline.llm import common
from offerline.llm.tokens import TEXT_AT_ONCE, crc, encoder

WRITER = {
    "compression": "zstd",
    "parquet.writer.version": "v2",             # delta encoding where no dictionary is used
    "parquet.block.size": str(32 << 20),        # row group
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",     # rows behind one entry of the page index
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.enable.dictionary#part_start": "false",
}
SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, part, part_start, n_tokens, ids) in id order within each part."""
    def run(batches):
        part, start = TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32)
        for batch in batches:
            coded = encoder(tokenizer).encode_column(batch.column(1))
            # Some rows at once: their ids are copied together.
            for a, b in common.slices(pc.binary_length(batch.column(1)).to_pylist(), TEXT_AT_ONCE):
                rows = [np.concatenate([ids, end]) for ids in itertools.islice(coded, b - a)]
                sizes = np.fromiter(map(len, rows), np.int64, len(rows))
                ends = np.cumsum(sizes)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                               pa.array(np.concatenate(rows).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.full(len(rows), part, np.int32)), pa.array(start + ends - sizes), pa.array(sizes), ids],
                    ["doc_id", "part", "part_start", "n_tokens", "ids"])
                start += int(ends[-1])

    text = common.text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t"), F.left(text, F.lit(32)).alias("lead"),
                       F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("row"))
    # An id on many rows is cut by its texts, equal texts by their place in the input.
    order = ["doc_id", "lead", "h", "row"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("doc_id", "t").mapInArrow(common.trimming(run), SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``path``/tokens and ``path``/parts."""
    encoded(docs, tokenizer, end_id, id_col, text_col).write.options(**WRITER).parquet(f"{path}/tokens")
    stored = docs.sparkSession.read.schema(SCHEMA).parquet(f"{path}/tokens")
    parts = stored.groupBy("part").agg(F.min("doc_id").alias("first_id"), F.sum("n_tokens").alias("tokens"))
    # One row a file: as many as the write had tasks.
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "part").rowsBetween(Window.unboundedPreceding, -1)
    parts.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens[, ids]); without ``ids`` no token page is read."""
    rows = spark.read.schema(SCHEMA).parquet(f"{path}/tokens")
    parts = spark.read.schema("part int, first_id long, tokens long, base long").parquet(f"{path}/parts")
    out = rows.join(F.broadcast(parts.select("part", "base")), "part")     # one row a file
    return out.select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", *["ids"] * ids)


def checksums(rows: DataFrame) -> DataFrame:
    """The rows of ``read_tokens`` with the crc32 of their ids instead of them."""
    def run(batch: pa.RecordBatch):
        ids = batch.column(3)
        values, at = ids.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
        sums = np.fromiter((crc(values[at[i]:at[i + 1]]) for i in range(batch.num_rows)), np.int64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return common.map_batches(rows, run, "doc_id long, start long, n_tokens long, ids_crc32 long")
