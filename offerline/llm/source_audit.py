"""Divergence of sources within a language by a frequent-pattern tree.

Every kept term is a row of counts, one a source. The divergence of two
sources sums, over all kept terms, a distance of their smoothed shares. Most
counts are zero, so the sum is taken apart: a term in neither source adds the
distance of the two zero shares; a term in one adds a correction against the
other's zero share; a term in both adds a correction of the pair. For the
last, the rows of nonzero counts, ordered by source, are inserted into a
tree with their multiplicities: rows that begin alike share nodes, and every
node gives one correction an ancestor, times the rows through it, instead of
one a term.

The rows are sorted before the tree is built, so it is split anywhere: each
batch of sorted rows is a tree of its own, and the corrections add up. No
term, source or language is gathered in one task; a term's row has at most
one entry a source, a language's table of sources one row each (the result
has a row for each pair of them).

Arithmetic is exact. With a count c, a group's sum N over the kept terms and V kept
terms, the share is 1 + floor(SCALE * (c + 2) / (N + 2V)), the distance of two shares
floor((p - q)^2 / (p + q)).

Rows: a null text, language or source counts as empty; repeated rows count
each; a group without kept terms has zero shares; a language without kept
terms has divergence 0; other columns are ignored; no rows give no result.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerline.llm import common
from offerline.operators.skew import salted_join

SCALE = 1_000_000_000
MIN_DOCS = 10
TOP_TERMS = 10
TERMS_AT_ONCE = 400_000     # counted by a task before it hands them on
# Bytes: A-Z to a-z; other ASCII that is no letter to a blank.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, counted in
    the tasks that read the texts; a term may come in several rows."""
    def run(batches):
        n, held, size = defaultdict(Counter), defaultdict(Counter), 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = text.encode("utf-8", "surrogatepass").translate(LETTERS).split()
                of_group = n[lang, source]
                size -= len(of_group)
                of_group.update(words)
                held[lang, source].update(set(words))
                size += len(of_group)
                if size > TERMS_AT_ONCE:
                    yield from packed(n, held)
                    n, held, size = defaultdict(Counter), defaultdict(Counter), 0
        yield from packed(n, held)

    def packed(n, held):
        for (lang, source), of_group in n.items():
            if of_group:
                terms, docs_with = list(of_group), held[lang, source]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                     pa.array(list(of_group.values()), pa.int64()), pa.array([docs_with[t] for t in terms], pa.int64())],
                    ["lang", "source", "term", "n", "docs"])

    rows = docs.select(common.text_of(lang_col).alias("lang"), common.text_of(source_col).alias("source"), common.text_of(text_col).alias("t"))
    return rows.mapInArrow(common.trimming(run), "lang string, source string, term string, n long, docs long")


def term_rows(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, total, row): the kept terms and their counts by source.
    One shuffle by (lang, term) serves both sums."""
    one = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    rows = one.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("row"))
    return rows.filter(F.col("docs") >= min_docs).drop("docs")


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (n + 2v)); null without kept terms."""
    big = lambda c: c.cast("decimal(25,0)")
    whole = F.call_function("div", F.lit(SCALE).cast("decimal(12,0)") * big(count + 2), F.when(v > 0, big(n + 2 * v)))
    return F.lit(1).cast("long") + whole


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def groups(docs: DataFrame, rows: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, id, n, lang_n, v, zero): every group with its place in
    the language's order (most occurrences first), sums and zero share."""
    seen = docs.select(common.text_of(lang_col).alias("lang"), common.text_of(source_col).alias("source")).distinct()
    sums = rows.select("lang", F.explode("row").alias("x")).groupBy("lang", F.col("x.source").alias("source")).agg(F.sum("x.n").alias("n"))
    kept = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    zero = F.lit(0).cast("long")
    known = seen.join(sums, ["lang", "source"], "left").join(kept, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "lang_n", "v")])
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "source"))
    return known.withColumns({"id": place, "zero": share(zero, F.col("n"), F.col("v"))})


def cells(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(lang, source, term, id, p, zero, q): the nonzero counts as shares, q
    the term's share in the language."""
    single = rows.select("lang", "term", "total", F.explode("row").alias("x")).select("lang", "term", "total", "x.source", "x.n")
    joined = salted_join(single, known.select("lang", "source", "id", F.col("n").alias("of_group"), "lang_n", "v", "zero"), ["lang", "source"], "inner")
    return joined.select("lang", "source", "term", "id", share(F.col("n"), F.col("of_group"), F.col("v")).alias("p"), "zero",
                         share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q"))


def tree_corrections(found: DataFrame) -> DataFrame:
    """(lang, a, b, value), a before b: corrections of the terms in both, one
    a node and ancestor of the tree of term rows."""
    paths = found.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("id", "p", "zero"))).alias("path"))
    paths = paths.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("m"))
    dealt = paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")

    def run(batch: pa.RecordBatch):
        langs, lists, times = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
        items = lists.flatten()
        ids, p, zero = (items.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
        starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).tolist()
        ids_, p_ = ids.tolist(), p.tolist()
        parent, item, weight, of_lang, stack = [], [], [], [], []
        names: dict[str, int] = {}
        for r, (lang, m) in enumerate(zip(langs, times)):
            code = names.setdefault(lang, len(names))
            first, end, shared = starts[r], starts[r + 1], 0
            if r and langs[r - 1] == lang:
                while shared < len(stack) and first + shared < end and (x := item[stack[shared]]) is not None and (ids_[x], p_[x]) == (ids_[first + shared], p_[first + shared]):
                    shared += 1
            del stack[shared:]
            for i in range(first + shared, end):
                parent.append(stack[-1] if stack else -1)
                item.append(i)
                weight.append(0)
                of_lang.append(code)
                stack.append(len(parent) - 1)
            for node in stack:
                weight[node] += m
        parent, item, weight, of_lang = (np.array(x, np.int64) for x in (parent, item, weight, of_lang))
        node, above = np.arange(len(parent)), parent.copy()
        gap = lambda x, y: (x - y) ** 2 // (x + y)
        keys, values = [], []
        width = int(ids.max()) + 1 if len(ids) else 1
        while len(node := node[above >= 0]):
            above = above[above >= 0]
            y, x = item[node], item[above]
            both = gap(p[x], p[y]) - gap(p[x], zero[y]) - gap(zero[x], p[y]) + gap(zero[x], zero[y])
            keys.append((of_lang[node] * width + ids[x]) * width + ids[y])
            values.append(both * weight[node])
            above = parent[above]
        if not keys:
            return
        pair, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, where, np.concatenate(values))
        back = list(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array([back[c] for c in (pair // width // width).tolist()], pa.string()), pa.array((pair // width % width).astype(np.int32)),
             pa.array((pair % width).astype(np.int32)), pa.array(total)], ["lang", "a", "b", "value"])

    return common.map_batches(dealt, run, "lang string, a int, b int, value long")


def divergence(known: DataFrame, found: DataFrame) -> DataFrame:
    """(lang, source, other, value): every ordered pair of sources of a language."""
    one = known.select("lang", F.col("id").alias("a"), F.col("zero").alias("zero_a"), "v")
    other = known.select("lang", F.col("id").alias("b"), F.col("zero").alias("zero_b"))
    pairs = one.join(other, "lang").filter("a <> b")
    neither = pairs.select("lang", "a", "b", F.coalesce(F.col("v") * distance(F.col("zero_a"), F.col("zero_b")), F.lit(0)).alias("value"))
    shares = found.groupBy("lang", F.col("id").alias("a"), F.col("zero").alias("zero_a"), "p").agg(F.count(F.lit(1)).alias("m"))
    single = salted_join(shares, other, "lang", "inner").filter("a <> b").groupBy("lang", "a", "b").agg(F.sum(
        F.col("m") * (distance(F.col("p"), F.col("zero_b")) - distance(F.col("zero_a"), F.col("zero_b")))).alias("value"))
    both = tree_corrections(found).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    uneven = single.unionByName(both)       # stands for both directions
    turned = uneven.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")
    total = neither.unionByName(uneven).unionByName(turned).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    names = known.select("lang", F.col("id").alias("a"), "source")
    return total.join(names, ["lang", "a"]).join(names.select("lang", F.col("a").alias("b"), F.col("source").alias("other")), ["lang", "b"]).select(
        "lang", "source", "other", "value")


def leading_terms(found: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, term, value, rank): each group's terms of a larger share
    than in the language, the farthest first. Groups are limited before the shuffle."""
    more = found.filter("p > q").select("lang", "source", "term", distance(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "term"))
    return more.withColumn("rank", rank).filter(F.col("rank") <= top)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> tuple[DataFrame, DataFrame]:
    """(divergence, leading_terms) of the sources in ``docs``."""
    rows = common.materialize(term_rows(term_counts(docs), min_docs), "term-rows")
    known = common.materialize(groups(docs, rows), "groups")
    found = common.materialize(cells(rows, known), "cells")
    return divergence(known, found), leading_terms(found, top)
