"""SimHash near-duplicates by segment-popcount embedding.

A fingerprint's 64 bits are cut into segments; the vector of the segments'
bit counts is a point of a small integer grid. One differing bit moves the
point by one step in one coordinate, so the Manhattan distance of two points
never exceeds the Hamming distance of their fingerprints. The grid range-join
lets both sides visit the points within half the distance: two points within
``max_bits`` steps share such a point on a shortest path, so no pair is lost.
Pairs that meet are verified on the fingerprints inside the join.

Copies collapse to one row per distinct fingerprint before anything is
joined; only verified links leave the join, and components come from the
links (see ``common.connected_components``).

Rows: a null or empty text has the fingerprint zero and is linked like any
other; repeated rows share a fingerprint; a null id is kept and never is a
component id unless all ids of the component are null.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerline.llm import common

SEGMENTS = 16  # of four bits: 5 counts each, so points are selective at any input size
HASH_SEED = 42
SHINGLES_AT_ONCE = 1 << 17


def shingle_hashes(text: str, k: int) -> list[int]:
    """XXH64 of the k-word shingles of a text, A-Z lower-cased, words
    separated by ASCII white space and joined by one space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    if len(words) <= k:
        return [xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)]
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    ends = (starts[k - 1:] + sizes[k - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], HASH_SEED) for s, e in zip(starts[:len(ends)].tolist(), ends)]


def fingerprint_of(hashes: np.ndarray) -> int:
    """The bits set in over half of ``hashes`` (uint64)."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[i:i + SHINGLES_AT_ONCE]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """(id, fp) per row, and the long ``key_col`` as key; fp holds the 64 bits as a signed long."""
    def run(batch: pa.RecordBatch):
        out = np.empty(batch.num_rows, np.uint64)
        for i, text in enumerate(batch.column(1)):
            out[i] = fingerprint_of(np.array(shingle_hashes(text.as_py(), k), np.uint64))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64)), *batch.columns[2:]], ["id", "fp", "key"][:batch.num_columns])

    key = [F.col(key_col).alias("key")] if key_col else []
    return common.map_batches(docs.select(F.col(id_col).cast("long").alias("id"), common.text_of(text_col).alias("t"), *key), run,
                              "id long, fp long" + ", key long" * len(key))


def grid_points(fps: DataFrame, radius: int, segments: int = SEGMENTS) -> DataFrame:
    """(cell, fp): every grid point within ``radius`` steps of a fingerprint's
    point, coordinates kept inside the grid (a shortest path stays inside)."""
    width = 64 // segments
    steps = [s for r in range(radius + 1) for s in itertools.combinations_with_replacement(
        [(d, v) for d in range(segments) for v in (1, -1)], r)]
    moves = np.unique(np.array([[sum(v for d, v in s if d == i) for i in range(segments)] for s in steps], np.int8), axis=0)
    scale = np.array([(width + 1) ** i for i in range(segments)], np.int64)

    def run(batch: pa.RecordBatch):
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        point = bits.reshape(len(fp), segments, width).sum(axis=2).astype(np.int8)
        for move in moves:
            at = point + move
            ok = ((at >= 0) & (at <= width)).all(axis=1)
            if ok.any():
                yield pa.RecordBatch.from_arrays([pa.array(at[ok].astype(np.int64) @ scale), pa.array(fp[ok])], ["cell", "fp"])

    return common.map_batches(fps.select("fp"), run, "cell long, fp long")


def links(fps: DataFrame, max_bits: int = 2, segments: int = SEGMENTS) -> DataFrame:
    """(a, b) of distinct fingerprints that differ in at most ``max_bits``."""
    near, far = max_bits // 2, max_bits - max_bits // 2
    left = grid_points(fps, near, segments)
    right = left if near == far else grid_points(fps, far, segments)
    a, b = left.alias("a"), right.alias("b")
    close = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    ordered = F.col("a.fp") < F.col("b.fp") if near == far else F.col("a.fp") != F.col("b.fp")
    # The points outnumber the fingerprints they come from: never broadcast.
    pairs = a.hint("merge").join(b, (F.col("a.cell") == F.col("b.cell")) & ordered & close)
    return pairs.select(F.least("a.fp", "b.fp").alias("a"), F.greatest("a.fp", "b.fp").alias("b")).distinct()


def with_roots(firsts: DataFrame, max_bits: int = 2, segments: int = SEGMENTS) -> DataFrame:
    """(fp, first, root) of distinct fingerprints (fp, first); equal roots are one component."""
    roots = common.connected_components(links(firsts, max_bits, segments))
    return firsts.join(roots, firsts.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))


def representatives(docs: DataFrame, key_col: str, k: int = 3, max_bits: int = 2, segments: int = SEGMENTS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key) of one row of each component, the smallest; ``key_col`` (long)
    tells rows with the same id apart."""
    prints = common.materialize(fingerprints(docs, k, id_col, text_col, key_col), "simhash")
    firsts = common.materialize(prints.groupBy("fp").agg(F.min(F.struct("id", "key")).alias("first")), "simhash-first")
    return with_roots(firsts, max_bits, segments).groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.key")


def near_duplicates(docs: DataFrame, k: int = 3, max_bits: int = 2, segments: int = SEGMENTS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) per row of ``docs``; component_id is the
    smallest id reachable over links of at most ``max_bits`` bits."""
    prints = common.materialize(fingerprints(docs, k, id_col, text_col), "simhash")
    firsts = common.materialize(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-first")
    rooted = with_roots(firsts, max_bits, segments)
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(lowest, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("id", "fp", "component_id")


def hex_digits(column: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
