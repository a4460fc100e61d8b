"""Packing by minimum bin slack.

A document's ids are cut at multiples of the window; the pieces of full
length are windows of their own. The remainders are dealt to groups of
bounded size. In a group, each window starts with the longest length left,
and a subset-sum over the multiset of the lengths left -- one bit a sum,
shifted by every length -- finds the sum that leaves the least padding (a
window whose fill is a power of two is not padded). The lengths are traced
back, and the window is repeated as often as their counts allow.

Rows: a null or empty text holds the end id alone; repeated rows are packed
as rows of their own; an empty table gives no pieces.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerline.llm import common
from offerline.llm.tokens import crc, encoder

WINDOW = 1024
GROUP = 50_000      # remainders packed by one task call; the slack of a group's last windows is spread over as many


def padding(fill: int, window: int) -> int:
    return 0 if fill & (fill - 1) == 0 else window - fill


def best_window(counts: np.ndarray, window: int) -> dict[int, int]:
    """{length: count} of the window that starts with the longest length
    left and has the least padding, the fuller one on ties."""
    longest = int(np.flatnonzero(counts)[-1])
    room = window - longest
    left = counts.copy()
    left[longest] -= 1
    mask = (1 << (room + 1)) - 1
    reach, steps, goal = 1, [], 1 << room
    for length in np.flatnonzero(left[:room + 1])[::-1].tolist():
        most, block = min(int(left[length]), room // length), 1
        while most > 0:     # 1, 2, 4 ... copies at once, the rest last
            copies = min(block, most)
            steps.append((length, copies, reach))
            reach |= (reach << (length * copies)) & mask
            most -= copies
            block *= 2
        if reach & goal:
            break
    sums = [s for s in [room] + [p - longest for p in (1 << i for i in range(window.bit_length())) if longest <= p <= window]
            if reach >> s & 1]
    fill = max(sums) if sums else reach.bit_length() - 1
    used = {longest: 1}
    for length, copies, before in reversed(steps):
        if not before >> fill & 1:
            fill -= length * copies
            used[length] = used.get(length, 0) + copies
    return used


def plan(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset in it) of every item."""
    order = np.argsort(lengths, kind="stable")
    counts = np.bincount(lengths, minlength=window + 1)
    next_of = np.cumsum(counts) - counts
    number, offset, windows = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    while counts.any():
        used = best_window(counts, window)
        times = min(int(counts[x]) // n for x, n in used.items())
        at = 0
        for length, n in used.items():
            for _ in range(n):
                items = order[next_of[length]:next_of[length] + times]
                number[items] = windows + np.arange(times)
                offset[items] = at
                next_of[length] += times
                counts[length] -= times
                at += length
        windows += times
    return number, offset


PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary"
BATCH_TOKENS = 1 << 20      # ids of one batch of pieces
BATCH_ROWS = 2_000      # whole texts handed to a Python worker at once: they stand in the JVM and in the worker


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document, in order; ``ids`` as little-endian
    unsigned 32-bit integers."""
    def run(batch: pa.RecordBatch):
        rows: list[tuple] = []
        held = 0
        for key, ids in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode_column(batch.column(1))):
            data = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
            n = len(data) // 4
            rows += [(key, at, min(window, n - at), n, data[4 * at:4 * (at + window)]) for at in range(0, n, window)]
            held += n
            if held >= BATCH_TOKENS:
                yield _table(rows)
                rows, held = [], 0
        if rows:
            yield _table(rows)

    return common.map_batches(docs.select(F.col(id_col).cast("long").alias("i"), common.text_of(text_col).alias("t")), run, PIECE)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.binary())],
                                      ["doc_id", "start", "length", "doc_tokens", "ids"])


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW,
         group: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces with their ids, sequence_id and offset."""
    cut = pieces(docs, tokenizer, end_id, window, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    with common.batch_rows(docs.sparkSession, BATCH_ROWS):
        rows = common.materialize(cut, "pieces")
    full = rows.filter(F.col("length") == window).withColumns({"sequence_id": F.col("row") * 2, "offset": F.lit(0).cast("long")})
    rest = rows.filter(F.col("length") < window)
    groups = max(1, -(-rest.count() // group))

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row", ignore_index=True)
        number, offset = plan(frame["length"].to_numpy(), window)
        return frame.assign(sequence_id=2 * (number * groups + int(key[0])) + 1, offset=offset)[["row", "sequence_id", "offset"]]

    placed = (rest.select("row", "length", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("g"))
              .groupBy("g").applyInPandas(common.trimming_groups(run), "row long, sequence_id long, offset long"))
    return full.unionByName(rest.join(placed.hint("shuffle_hash"), "row")).drop("row")


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids, pieces): whole sequences with every piece
    at its offset, padded unless their fill is a power of two; ``ids`` as in
    ``packed``, the pieces' doc_id, start and doc_tokens by offset."""
    piece = F.struct("offset", "doc_id", "start", "doc_tokens", "ids").alias("p")
    # A piece of full length is a sequence as it is.
    full = packed.filter(F.col("length") == window).select("sequence_id", F.array(piece).alias("pieces"))
    rest = (packed.filter(F.col("length") < window).select("sequence_id", piece)
            .groupBy("sequence_id").agg(F.array_sort(F.collect_list("p")).alias("pieces")))
    facts = pa.struct([(c, pa.int64()) for c in ("offset", "doc_id", "start", "doc_tokens")])

    def run(batch: pa.RecordBatch):
        lists = batch.column(1)
        flat = lists.flatten()
        cols = dict(zip([f.name for f in flat.type], flat.flatten()))
        ids, offsets = cols["ids"], cols["offset"].to_pylist()
        cuts = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
        sizes, built = [], []
        for a, b in zip(cuts, cuts[1:]):
            parts = [ids[i].as_buffer() for i in range(a, b)]
            n = sum(p.size for p in parts) // 4
            out = np.full(n + padding(n, window), pad_id, "<u4")
            for at, p in zip(offsets[a:b], parts):
                out[at:at + p.size // 4] = np.frombuffer(p, "<u4")
            sizes.append(n)
            built.append(out.tobytes())
        own = pa.StructArray.from_arrays([cols[f.name] for f in facts], fields=list(facts))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(built, pa.binary()),
                                          pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), own)], ["sequence_id", "n_tokens", "ids", "pieces"])

    return common.map_batches(full.unionByName(rest), run, "sequence_id long, n_tokens long, ids binary, "
                              "pieces array<struct<offset:long,doc_id:long,start:long,doc_tokens:long>>")


def read_back(seqs: DataFrame, whole: bool = False) -> DataFrame:
    """One row a piece, its length and ids_crc32 from the slice of its
    sequence at its offset. With ``whole`` the sequence's ids, padding
    included, stand on the row of its first piece (``sequence``)."""
    def run(batch: pa.RecordBatch):
        cols: list[list] = [[] for _ in range(8)]
        for number, n, data, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
            ids = np.frombuffer(data.as_buffer(), "<u4")
            for p, stop in zip(own, [q["offset"] for q in own[1:]] + [n]):
                part = ids[p["offset"]:stop]
                for col, x in zip(cols, (p["doc_id"], p["start"], len(part), crc(part), p["doc_tokens"], number, p["offset"],
                                         ids.astype(np.int32) if whole and p["offset"] == 0 else None)):
                    col.append(x)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
        if whole:
            arrays, names = [*arrays, pa.array(cols[7], pa.list_(pa.int32()))], [*names, "sequence"]
        yield pa.RecordBatch.from_arrays(arrays, names)

    return common.map_batches(seqs, run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
                              + ", sequence array<int>" * whole)
