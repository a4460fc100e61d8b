"""Chat formatting as a prefix tree.

Every distinct sequence of initial turns is one node; conversations that
share initial turns share the nodes. A node holds the tokens of its last
turn. Nodes are laid out depth first in one token stream, each once, with the
position of its first token in the conversation and the stream intervals of
its ancestors: a token attends to those intervals and to its own node up to
itself, which is what it would see in the conversation written out alone.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Inside roles and
texts a backslash is doubled and ``<|`` becomes ``<\\|`` (a line break in a
role ``\\n``), so no text can hold a control string, and reading undoes it.
Header, text and footer are encoded apart: the loss mask of an assistant turn
covers exactly the tokens of its text.

Rows: a null role or text counts as empty; repeated rows of a conversation
are kept, ordered by turn, role and text; a null conversation id is a
conversation of its own; without rows there are no nodes.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerline.llm import common
from offerline.llm.tokens import encoder

HEAD, MID, TAIL = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNED_ROLE = "assistant"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    """Header, body and footer of a turn."""
    return HEAD + escape(role).replace("\n", "\\n") + MID, escape(text), TAIL


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    role, _, text = formatted[len(HEAD):-len(TAIL)].partition(MID)
    return unescape(role), unescape(text)


def conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv_id, rank, turns): the turns of each conversation with the key of
    the node they lead to; ranks follow the order of the paths, a path before
    its extensions."""
    turn = F.struct(F.col(turn_col).cast("long").alias("turn"), common.text_of(role_col).alias("role"), common.text_of(text_col).alias("text"))
    whole = rows.select(F.col(id_col).cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("t")).alias("turns"))
    kind = pa.list_(pa.struct([("key", pa.string()), ("role", pa.string()), ("text", pa.string())]))

    def run(batch: pa.RecordBatch):
        turns, paths = [], []
        for conv in batch.column(1).to_pylist():
            key, own, path = "", [], []
            for t in conv:
                role, text = t["role"].encode(), t["text"].encode()
                key = hashlib.blake2b(b"%s %d %s%s" % (key.encode(), len(role), role, text), digest_size=16).hexdigest()
                own.append({"key": key, "role": t["role"], "text": t["text"]})
                path.append(key)
            turns.append(own)
            paths.append("".join(path))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string()), pa.array(turns, kind)], ["conv_id", "path", "turns"])

    keyed = common.map_batches(whole, run, "conv_id long, path string, turns array<struct<key:string,role:string,text:string>>")
    ranked = keyed.orderBy("path", "conv_id").withColumn("rank", F.monotonically_increasing_id())
    return common.materialize(ranked.select("conv_id", "rank", "turns"), "conversations")


def steps(convs: DataFrame) -> DataFrame:
    """(conv_id, rank, depth, key, role, text): one row a turn."""
    return convs.select("conv_id", "rank", F.posexplode("turns").alias("depth", "t")).select(
        "conv_id", "rank", "depth", "t.key", "t.role", "t.text")


def nodes(convs: DataFrame, tokenizer: str) -> DataFrame:
    """The tree, a row a node: key, rank and depth of its first conversation,
    ids, loss interval within the ids, stream_start, position_start and the
    ancestors' stream intervals (root first)."""
    distinct = steps(convs).groupBy("key").agg(F.min(F.struct("rank", "depth", "role", "text")).alias("n")).select("key", "n.*")

    def run(batches):
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            turns = [format_turn(r, t) for r, t in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            parts = encoder(tokenizer).encode([x for t in turns for x in t])
            ids = [np.concatenate(parts[i:i + 3]) for i in range(0, len(parts), 3)]
            head = np.array([len(parts[i]) for i in range(0, len(parts), 3)], np.int64)
            body = np.array([len(parts[i + 1]) for i in range(0, len(parts), 3)], np.int64)
            body[[r != LEARNED_ROLE for r in batch.column(3).to_pylist()]] = 0
            size = np.array([len(x) for x in ids], np.int64)
            ends = np.cumsum(size)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(np.concatenate(ids).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.full(len(ids), part, np.int32)), pa.array(start + ends - size), pa.array(size), lists, pa.array(head), pa.array(body)],
                ["key", "rank", "depth", "part", "part_start", "n_tokens", "ids", "loss_start", "loss_length"])
            start += int(ends[-1])

    laid = common.materialize(distinct.orderBy("rank", "depth").mapInArrow(common.trimming(run), "key string, rank long, depth int, part int, part_start long, n_tokens long, ids array<int>, loss_start long, loss_length long"), "nodes")
    parts = laid.groupBy("part").agg(F.sum("n_tokens").alias("n"))      # one row a sort partition
    base = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    placed = laid.join(F.broadcast(base), "part").withColumn("stream_start", F.col("base") + F.col("part_start")).drop("part", "part_start", "base")
    # The intervals on the path of every conversation that is the first one of a node.
    firsts = placed.select("rank").distinct()
    path = (steps(convs).select("rank", "depth", "key").join(firsts, "rank", "left_semi")
            .join(placed.select("key", "stream_start", "n_tokens"), "key")
            .groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("depth", F.col("stream_start").alias("start"), F.col("n_tokens").alias("length")))).alias("path")))
    above = F.slice("path", 1, F.col("depth"))
    return placed.join(path, "rank").select(
        "key", "rank", "depth", "n_tokens", "ids", "loss_start", "loss_length", "stream_start",
        F.aggregate(above, F.lit(0).cast("long"), lambda s, x: s + x["length"]).alias("position_start"),
        F.transform(above, lambda x: F.struct(x["start"], x["length"])).alias("ancestors"))


def read_back(convs: DataFrame, tree: DataFrame, tokenizer: str) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, position_start, n_ancestors), decoded from the tree's
    tokens: a node once, then a conversation from the intervals of the token
    stream that its last node attends to. position_start and n_ancestors are
    those of the last node."""
    def decode(batch: pa.RecordBatch):
        tokenizer_ = encoder(tokenizer).tokenizer
        out = [[] for _ in range(5)]
        for ids, at, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            formatted = tokenizer_.decode(ids, skip_special_tokens=False)
            role, text = parse_turn(formatted)
            for col, x in zip(out, (role, text, unescape(tokenizer_.decode(ids[at:at + n], skip_special_tokens=False)), len(formatted), len(ids))):
                col.append(x)
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.string()) for c in out[:3]], *[pa.array(c, pa.int64()) for c in out[3:]]],
                                         ["start", "role", "text", "loss", "chars", "length"])

    read = common.map_batches(tree.select("stream_start", "ids", "loss_start", "loss_length"), decode,
                              "start long, role string, text string, loss string, chars long, length long")
    ends = convs.select("conv_id", F.get("turns", F.size("turns") - 1)["key"].alias("leaf"))
    leaves = common.materialize(tree.withColumnRenamed("key", "leaf").join(ends.select("leaf").distinct(), "leaf", "left_semi").select(
        "leaf", "position_start", "ancestors", F.struct(F.col("stream_start").alias("start"), F.col("n_tokens").alias("length")).alias("own")), "leaves")      # equal conversations are read once
    attended = leaves.select("leaf", F.posexplode(F.concat("ancestors", F.array("own"))).alias("depth", "x")).select("leaf", "depth", "x.start", "x.length")
    turns = (attended.join(read, ["start", "length"])
             .groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("depth", "role", "text", "loss", "chars"))).alias("turns")))

    def digest(batch: pa.RecordBatch):
        out = [[] for _ in range(5)]
        for conv in batch.column(1).to_pylist():
            said, loss = hashlib.sha256(), "".join(t["loss"] for t in conv)
            for t in conv:
                said.update(f"{t['role']}\n{t['text']}\n".encode())
            for col, x in zip(out, (len(conv), said.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(t["chars"] for t in conv))):
                col.append(x)
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in out]],
                                         ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    digests = common.map_batches(turns, digest, "leaf string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    placed = leaves.select("leaf", "position_start", F.size("ancestors").cast("long").alias("n_ancestors"))
    return ends.join(digests.join(placed, "leaf"), "leaf").drop("leaf")
