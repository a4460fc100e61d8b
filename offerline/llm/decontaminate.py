"""Benchmark decontamination with one Aho-Corasick automaton.

The benchmark texts are normalised (A-Z lower-cased; words are runs of
digits, letters and non-ASCII characters) and cut into windows of
consecutive words; a shorter text is one window. The automaton over all
distinct windows reads each normalised document once; every match marks its
words, and the marked words are mapped to character offsets of the original.

The automaton is sent to every task, so its size is checked: windows are
dealt to as many automata as keep each below ``max_pattern_bytes``, and a
benchmark that needs more than one is run pass by pass over stored results.

Rows: null or empty texts have no words and no hits; an item without words
matches nothing; repeated items all are reported.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerline.llm import common

WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
# Bytes: A-Z to a-z; other ASCII that is no digit or letter to a blank.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
MAX_PATTERN_BYTES = 64 << 20
HIT = "array<struct<word:int,start:int,end:int>>"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(NORMAL).split()


def framed(words: list[bytes]) -> str:
    """Words between single blanks, one at each end; one character a byte."""
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def windows(benchmark: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(pattern, items): the distinct windows and the items that hold them."""
    def run(batch: pa.RecordBatch):
        patterns, items = [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(text)
            if words:
                for i in range(max(1, len(words) - size + 1)):
                    patterns.append(framed(words[i:i + size]))
                    items.append(item)
        yield pa.RecordBatch.from_arrays([pa.array(patterns, pa.string()), pa.array(items, pa.string())], ["pattern", "item"])

    rows = common.map_batches(benchmark.select(F.col(id_col).cast("string").alias("i"), common.text_of(text_col).alias("t")), run,
                              "pattern string, item string")
    return rows.groupBy("pattern").agg(F.array_sort(F.collect_set("item")).alias("items"))


def automaton(patterns: list[str]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for i, p in enumerate(patterns):
        out.add_word(p, (i, p.count(" ") - 1))
    out.make_automaton()
    return out


def hits_of(text: str, machine) -> tuple[int, list[int], list[int]]:
    """Number of words, ascending numbers of the words inside a match, and
    the patterns found. The document's words are counted lazily: a match is
    placed by the blanks before it."""
    words = words_of(text)
    if not words:
        return 0, [], []
    line = framed(words)
    marked, found, at, blanks = set(), set(), 0, 0
    for end, (pattern, length) in machine.iter(line):
        blanks += line.count(" ", at, end)
        at = end
        marked.update(range(blanks - length, blanks))
        found.add(pattern)
    return len(words), sorted(marked), sorted(found)


def scan(docs: DataFrame, patterns: list, out_columns: list[str]) -> DataFrame:
    """One pass over ``docs`` (id, t, carried columns and, after an earlier
    pass, n_words, hits and items) that adds the hits of ``patterns``."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast([(r["pattern"], r["items"]) for r in patterns])
    hit = pa.list_(pa.struct([("word", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        rows = sent.value
        machine = automaton([p for p, _ in rows])
        for batch in batches:
            have = dict(zip(batch.schema.names, batch.columns))
            count, hits, items = np.zeros(batch.num_rows, np.int64), [], []
            for i, text in enumerate(have["t"]):
                text = text.as_py()
                count[i], marked, found = hits_of(text, machine) if rows else (len(words_of(text)), [], [])
                known = {h["word"]: h for h in have["hits"][i].as_py()} if "hits" in have else {}
                if marked:
                    spans = [m.span() for m in WORD.finditer(text)]
                    known.update({w: {"word": w, "start": spans[w][0], "end": spans[w][1]} for w in marked})
                hits.append([known[w] for w in sorted(known)])
                items.append(sorted({x for p in found for x in rows[p][1]}
                                    | set(have["items"][i].as_py() if "items" in have else ())))
            have |= {"n_words": pa.array(count), "hits": pa.array(hits, hit), "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([have[c] for c in out_columns], out_columns)

    kinds = dict(docs.dtypes) | {"n_words": "long", "hits": HIT, "items": "array<string>"}
    return docs.mapInArrow(common.trimming(run), ", ".join(f"`{c}` {kinds[c]}" for c in out_columns))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", carry: tuple = (),
                  max_pattern_bytes: int = MAX_PATTERN_BYTES) -> DataFrame:
    """(id, n_words, hits, items) and the columns of ``carry``, per row:
    ``hits`` are the words inside a window's occurrence with their character
    offsets, ``items`` the benchmark items found, as strings in string order."""
    rows = common.materialize(windows(benchmark, size, item_col, item_text_col), "windows")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("pattern") + F.size("items") * 8), F.lit(0)).alias("b")).first()["b"]
    parts = max(1, -(-total // max_pattern_bytes))
    out = docs.select(F.col(id_col).cast("long").alias("id"), common.text_of(text_col).alias("t"),
                      *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)])
    kept = ["id", *[f"carry_{i}" for i in range(len(carry))], "n_words", "hits", "items"]
    for part in range(parts):
        own = rows.filter(F.pmod(F.xxhash64("pattern"), F.lit(parts)) == part).collect()
        last = part == parts - 1
        out = scan(out, own, kept if last else [*kept, "t"])
        if not last:
            out = common.materialize(out, "decontaminate")
    return out.withColumnsRenamed({f"carry_{i}": c for i, c in enumerate(carry)})
