"""Helpers the operators share: shared folders, hashing by key, components."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``). Only a
    local session without one (tests) gets a folder of its own."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if path is None and sc.getCheckpointDir() is not None:
        path = sc.getCheckpointDir()
    if path is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="offerline-llm-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a context."""
    sc = spark.sparkContext
    if getattr(sc, "_offerline_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="offerline-py-"), "offerline.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._offerline_shipped = True


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to a new shared folder and read it back: cuts
    the lineage, so a lost executor rereads files instead of recomputing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def id_crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as '')."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def release() -> None:
    """Give freed memory back to the system: workers are used again by later
    stages and would hold on to it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):   # another C library
        pass


def trimming(fn: Callable) -> Callable:
    """A ``mapInArrow`` function that releases memory after each batch."""
    def run(batches):
        for out in fn(batches):
            yield out
            release()
        release()

    return run


def trimming_groups(fn: Callable) -> Callable:
    """The same for a function of ``applyInPandas``."""
    def run(key, frame):
        try:
            return fn(key, frame)
        finally:
            release()

    return run


@contextlib.contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand Python workers at most ``rows`` rows at once in the jobs run within."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if int(before) <= 0 or int(before) > rows:
        spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(trimming(run), schema)


def first_ids(ids: DataFrame, n: int, seed: str) -> DataFrame:
    """(g, id, h) of the ``n`` distinct ids of smallest hash in each group g
    of ``ids`` (g, id). Counts by the hash's upper 16 bits tell how far up
    these reach, so that only they and the rest of one 65,536th are ranked."""
    rows = ids.distinct().select("g", "id", F.xxhash64(F.lit(seed), "id").alias("h")).withColumn("b", F.shiftright("h", 48))
    before = F.sum("n").over(Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    reached = (rows.groupBy("g", "b").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < n).select("g", "b"))
    rank = F.row_number().over(Window.partitionBy("g").orderBy("h", "id"))
    return rows.join(F.broadcast(reached), ["g", "b"]).withColumn("r", rank).filter(F.col("r") <= n).select("g", "id", "h")


def sample_texts(docs: DataFrame, ids: DataFrame, n: int, seed: str, max_bytes: int | None = None, by_group: bool = False) -> DataFrame:
    """(g, r, id, t): a sample of at most ``n`` distinct rows of each group,
    the first ones by (hash of the id, id, hash of the text), numbered from 1;
    with ``max_bytes`` as many as start within so many bytes of text.

    ``ids`` (g, id) has the ids to choose from and their groups, all of them
    ids of ``docs`` (id, t, and g where ``by_group``: then a row is of its own
    group only). Rows are chosen, not ids: an id on many rows brings no more
    than ``n``, copies of a row count once. Null ids are an id like others.
    The same rows give the same sample in every run."""
    chosen = first_ids(ids, n, seed).select(F.col("g").alias("cg"), F.col("id").alias("cid"), "h")
    own = F.col("id").eqNullSafe(F.col("cid"))
    if by_group:
        own = own & (F.col("g") == F.col("cg"))
    rows = docs.select("id", "t", *["g"] * by_group).join(F.broadcast(chosen), own)      # at most n rows a group broadcast
    narrow = rows.select("cg", "h", "id", F.xxhash64("t").alias("x"), F.octet_length("t").cast("long").alias("n")).distinct()
    order = Window.partitionBy("cg").orderBy("h", "id", "x")
    picks = narrow.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= n)
    if max_bytes is not None:
        past = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
        picks = picks.withColumn("past", F.coalesce(past, F.lit(0))).filter(F.col("past") < max_bytes)
    picks = picks.select("cg", F.col("id").alias("cid"), F.col("x").alias("cx"), "r")
    own = own & (F.xxhash64("t") == F.col("cx"))
    if by_group:
        own = own & (F.col("g") == F.col("cg"))
    return (docs.select("id", "t", *["g"] * by_group).join(F.broadcast(picks), own)
            .groupBy(F.col("cg").alias("g"), "r").agg(F.min("id").alias("id"), F.min("t").alias("t")))


def slices(lengths, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose lengths sum to at most ``limit`` (one item at
    least), so that working arrays stay bounded."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest
    node reachable. Alternates large-star and small-star steps; each round is
    written to the shared folder, and only two counters reach the driver."""
    spark = edges.sparkSession
    shared_dir(spark)
    current = (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .filter("a <> b").distinct().checkpoint())
    state = _fingerprint(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        current = small.filter("a <> b").distinct().checkpoint()
        new = _fingerprint(current)
        if new == state:
            break
        state = new
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]
