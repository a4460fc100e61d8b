"""Prefix trie of sequences of turns by van Emde Boas recursion.

A depth range is cut at half its depth. Its upper half keeps the name of the
range's first prefix; the lower half starts at the cut prefix, named by the
first prefix and the upper half's block of turns. Once the cut prefixes are
named, both halves are built without each other, so all ranges of a level
are one step, and a sequence of n turns takes log2(n) steps however long it
is. Block names come from the shortest blocks up, two of them giving the
next. Ranges of ``BASE_TURNS`` turns are named within one row.

A node is a distinct prefix. Totals are grafted upward the same way: each
node's own value lies on its smallest member's sequence; the sum of a lower
half is added to every place of the upper half beside it, level by level, and
the members' sums of a node add up to its subtree's total.

No sequence, node or level is gathered in one task: turns are numbered by a
range sort whose only carried state is one row a partition and sequence, a
level's rows are keyed by (sequence, block), and nodes are partial
aggregates. Names are the first 128 bits of SHA-256.

Rows: a null role or text counts as empty, a null turn comes first; rows of
one turn are ordered by a digest of role and text; repeated rows are turns of
their own; rows without a sequence id belong to no sequence and are left
out; other columns are ignored; without rows there are no nodes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerline.llm import common
from offerline.operators.skew import salted_join

BASE_TURNS = 8
ID_BITS = 8         # ids equal but for so many bits are joined in one row before the digest
WORD = r"[^\x20\x09-\x0D]+"


def _root() -> Column:
    return F.unhex(F.lit("00" * 16))


def _name(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(c, pos, n, e, w): every row's place in its sequence from 0, the
    sequence's length, the turn's digest and its number of words."""
    role, text = common.text_of(role_col), common.text_of(text_col)
    own = rows.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("c"), F.col(turn_col).cast("long").alias("t"),
        _name(F.concat(F.octet_length(role).cast("string"), F.lit(" "), role, text).cast("binary")).alias("e"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("w"))
    laid = own.orderBy("c", F.col("t").asc_nulls_first(), "e").withColumn("m", F.monotonically_increasing_id())
    laid = common.materialize(laid.withColumn("p", F.shiftright("m", 33)).drop("t"), "turns")
    runs = laid.groupBy("c", "p").agg(F.min("m").alias("first"), F.count(F.lit(1)).alias("size"))
    parts = Window.partitionBy("c")     # one row a partition that holds the sequence
    before = F.sum("size").over(parts.orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("c", "p", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("size").over(parts).alias("n"))
    return common.materialize(laid.join(runs, ["c", "p"]).select(
        "c", (F.col("m") - F.col("first") + F.col("before")).alias("pos"), "n", "e", "w"), "numbered")


def rebuilt(numbered: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Sequences that take their first turns from the first one of their
    family: (c, i, e, w) and (c, len). Sequence c takes the first h turns of
    c - c % family, then its own behind its first h; h is the crc32 of c in
    decimal modulo ``heads``. The remainder has the sign of c, as in SQL."""
    every = numbered.groupBy("c").agg(F.max("n").alias("n"))
    every = every.withColumns({"h": F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(heads)),
                               "b": F.col("c") - F.col("c") % F.lit(family)})
    donors = numbered.filter(F.col("pos") < heads - 1).select(F.col("c").alias("b"), "pos", "e", "w")
    sizes = donors.groupBy("b").agg(F.count(F.lit(1)).alias("m"))
    every = every.join(sizes, "b", "left").withColumn("m", F.least("h", F.coalesce("m", F.lit(0))))
    taken = every.join(donors, "b").filter(F.col("pos") < F.col("h")).select("c", F.col("pos").alias("i"), "e", "w")
    lengths = every.select("c", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"), F.col("h"), "m")
    own = salted_join(numbered.select("c", "pos", "e", "w"), lengths.select("c", "h", "m"), "c", "inner").filter(
        F.col("pos") >= F.col("h")).select("c", (F.col("pos") - F.col("h") + F.col("m")).alias("i"), "e", "w")
    return own.unionByName(taken), lengths.select("c", "len")


def _pairs(blocks: DataFrame) -> DataFrame:
    """Blocks of the next level: two whole neighbours give one."""
    two = blocks.groupBy("c", F.shiftright("k", 1).alias("k")).agg(
        F.max(F.when(F.col("k") % 2 == 0, F.col("name"))).alias("l"), F.max(F.when(F.col("k") % 2 == 1, F.col("name"))).alias("r"))
    return two.filter(F.col("l").isNotNull() & F.col("r").isNotNull()).select("c", "k", _name("l", "r").alias("name"))


def prefixes(sequences: DataFrame, lengths: DataFrame, base: int = BASE_TURNS) -> tuple[DataFrame, int]:
    """((c, k, at, es), levels): for every sequence and range k of ``base``
    places, the names of the prefixes that end at its places, and the turns
    behind them (e null and w 0 behind the last turn)."""
    ends = lengths.select("c", F.col("len").alias("i"), F.lit(None).cast("binary").alias("e"), F.lit(0).cast("long").alias("w"))
    ranges = common.materialize(
        sequences.unionByName(ends).groupBy("c", F.floor(F.col("i") / F.lit(base)).alias("k"))
        .agg(F.array_sort(F.collect_list(F.struct("i", "e", "w"))).alias("es")), "ranges")
    top = ranges.agg(F.max("k").alias("k")).first()["k"]
    if top is None:
        return ranges.select("c", "k", F.array(_root()).alias("at"), "es"), 0
    levels = int(top).bit_length()
    last = F.get("es", F.lit(base - 1))["e"]        # null where the range is not whole
    blocks = [ranges.filter(last.isNotNull()).select("c", "k", _name(F.array_join(F.transform("es", lambda x: F.hex(x["e"])), "").cast("binary")).alias("name"))]
    for j in range(1, levels):
        blocks.append(common.materialize(_pairs(blocks[-1]), f"blocks-{j}"))
    named = lengths.select("c", F.lit(0).cast("long").alias("k"), _root().alias("name"))
    for j in reversed(range(levels)):
        upper = blocks[j].filter(F.col("k") % 2 == 0).select("c", F.shiftright("k", 1).alias("k"), F.col("name").alias("block"))
        cut = named.join(upper, ["c", "k"]).select("c", (F.col("k") * 2 + 1).alias("k"), _name("name", "block").alias("name"))
        named = common.materialize(named.withColumn("k", F.col("k") * 2).unionByName(cut), f"cuts-{j}")
    step = lambda a, x: F.array_append(a, _name(F.element_at(a, -1), x["e"]))
    inner = F.aggregate(F.slice("es", 1, F.size("es") - 1), F.array("name"), step)
    return ranges.join(named, ["c", "k"]).select("c", "k", inner.alias("at"), "es"), levels


def _grafted(values: DataFrame, levels: int) -> DataFrame:
    """(c, k, leaves, saved) of every range: what the lower halves beside and
    above it hold, grafted upward cut by cut."""
    total = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    sums = [values]
    for j in range(1, levels):
        sums.append(common.materialize(sums[-1].groupBy("c", F.shiftright("k", 1).alias("k")).agg(*total), f"sums-{j}"))
    zero = F.lit(0).cast("long")
    behind = values.select("c").distinct().select("c", zero.alias("k"), zero.alias("leaves"), zero.alias("saved"))
    for j in reversed(range(levels)):
        lower = sums[j].filter(F.col("k") % 2 == 1).select("c", (F.col("k") - 1).alias("k"), "leaves", "saved")
        halves = behind.select("c", F.explode(F.array(F.col("k") * 2, F.col("k") * 2 + 1)).alias("k"), "leaves", "saved")
        known = sums[j].select("c", "k")
        behind = common.materialize(
            halves.unionByName(lower).groupBy("c", "k").agg(*total).join(known, ["c", "k"], "left_semi"), f"grafts-{j}")
    return behind


def trie(sequences: DataFrame, lengths: DataFrame, base: int = BASE_TURNS) -> tuple[DataFrame, DataFrame]:
    """((node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens), (node, c)): one row a node, named by its smallest member
    and depth, and for each sequence the node it ends at."""
    at, levels = prefixes(sequences, lengths, base)
    at = common.materialize(at, "prefixes")
    places = at.select("c", "k", F.explode(F.arrays_zip(F.col("at"), F.col("es"))).alias("x")).select(
        "c", "k", F.col("x.at").alias("node"), F.col("x.es.i").alias("i"), F.col("x.es.e").alias("e"), F.col("x.es.w").alias("w"))
    # One row a node and next turn; the row without a next turn counts the sequences that end there.
    edges = common.materialize(places.groupBy("node", "e").agg(
        F.min("c").alias("c"), F.min("i").alias("depth"), F.count(F.lit(1)).alias("n"), F.max("w").alias("w")), "edges")
    nodes = common.materialize(edges.groupBy("node").agg(
        F.min("c").alias("conv_id"), F.min("depth").alias("depth"), F.sum("n").alias("n_convs"),
        F.count("e").alias("n_children")), "trie-nodes")
    above = nodes.select("node", F.col("conv_id").alias("parent_conv_id"))
    children = salted_join(edges.filter(F.col("e").isNotNull()), above, "node", "inner").select(
        F.col("c").alias("conv_id"), (F.col("depth") + 1).alias("depth"), "parent_conv_id", "w")
    nodes = common.materialize(nodes.join(children, ["conv_id", "depth"], "left"), "trie-parents")
    # A node's own value lies on its smallest member, at the node's depth.
    own = nodes.select(
        F.col("conv_id").alias("c"), F.col("depth").alias("i"), (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.coalesce("w", F.lit(0))).alias("save"))
    held = places.select("c", "k", "i", "node").join(own, ["c", "i"], "left").groupBy("c", "k").agg(
        F.array_sort(F.collect_list(F.struct(F.col("i"), F.col("node"), F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("save", F.lit(0)).alias("save")))).alias("xs"))
    held = common.materialize(held, "values")
    whole = lambda f: F.aggregate("xs", F.lit(0).cast("long"), lambda s, x: s + x[f])
    grafts = _grafted(held.select("c", "k", whole("leaf").alias("leaves"), whole("save").alias("saved")), levels)
    rest = lambda f: F.transform("xs", lambda x, p: F.aggregate(
        F.slice("xs", p + 1, F.size("xs")), F.col({"leaf": "leaves", "save": "saved"}[f]), lambda s, y: s + y[f]))
    sums = held.join(grafts, ["c", "k"]).select(F.explode(F.arrays_zip(
        F.transform("xs", lambda x: x["node"]).alias("node"), rest("leaf").alias("l"), rest("save").alias("s"))).alias("x"))
    totals = sums.groupBy(F.col("x.node").alias("node")).agg(F.sum("x.l").alias("n_leaves"), F.sum("x.s").alias("saved_tokens"))
    return nodes.drop("w").join(totals, "node"), places.filter(F.col("e").isNull()).select("node", "c")


def ends_digest(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the ids that end at each node, in
    decimal, ascending, comma-joined. Ids are joined in rows of a bounded
    range first; a node's rows are then read in order, one at a time."""
    texts = ends.groupBy("node", F.shiftright("c", ID_BITS).alias("bucket")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches):
        now, state = None, None
        for batch in batches:
            names, digests = [], []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    names.append(now)
                    digests.append(state.hexdigest())
                now, state = node, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], ["node", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    return (texts.repartition("node").sortWithinPartitions("node", "bucket").select("node", "ids")
            .mapInArrow(run, "node binary, ends_sha256 string"))
