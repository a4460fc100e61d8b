"""Language identification by prediction by partial matching (PPM).

Per language a context tree of bytes is counted over a bounded training
sample: order ``ORDER`` contexts and all shorter ones. With the statistics
frozen, a byte costs -log2 of its probability in the longest context that is
in the tree; a byte not seen there pays the escape probability (method C:
distinct successors / (count + distinct)) and goes on in the next shorter
context with the bytes already ruled out excluded, down to a uniform choice
among the bytes never seen. A text's code length in a language is the exact
sum over all its bytes; the shortest code wins.

The trees are sorted arrays of (context, byte) keys. A byte's cost depends
only on itself and the bytes before it, so each distinct n-gram is looked up
once and a text's code length is a sum of table entries.

Rows: null texts and texts without a letter are ``und`` with score 0; ties
go to the first language in name order; rows equal in id, language and text
count once in the sample, an id on many rows brings no more than the sample's
bound, rows without an id are learned from like others; without any training
row every text is ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerline.llm import common

ORDER = 3
DOCS_PER_LANGUAGE = 400         # training sample: at most so many documents a language, taken whole, ...
BYTES_PER_LANGUAGE = 24 << 20   # ... until they hold so many bytes: the model's size is bounded
SCALE = 0.05                # share of a byte's cost difference that counts as evidence
TABLE_BITS = 22
START = b"\n" * ORDER       # what stands before a text
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


def grams(data: np.ndarray) -> np.ndarray:
    """Codes of the n-grams that end at each byte after the first ORDER."""
    code = np.zeros(len(data) - ORDER, np.uint32)
    for i in range(ORDER + 1):
        code = (code << np.uint32(8)) | data[i:len(data) - ORDER + i]
    return code


class ContextTree:
    """Frozen byte statistics of one language, built from n-gram counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.levels = []    # by context length: (context, byte) keys, counts, context keys, totals, distinct
        for k in range(ORDER + 1):
            key, at = np.unique(codes.astype(np.uint64) & np.uint64((1 << (8 * (k + 1))) - 1), return_inverse=True)
            n = np.bincount(at, weights=counts, minlength=len(key))
            context, own = np.unique(key >> np.uint64(8), return_inverse=True)
            self.levels.append((key, n, context, np.bincount(own, weights=n), np.bincount(own)))
        self.masked = [None]    # of each context: counts and number of its successors, in the next shorter context
        for k in range(1, ORDER + 1):
            key, _, context, _, _ = self.levels[k]
            short, n, *_ = self.levels[k - 1]
            at = np.searchsorted(short, key & np.uint64((1 << (8 * k)) - 1))
            own = np.searchsorted(context, key >> np.uint64(8))
            self.masked.append(np.bincount(own, weights=n[at], minlength=len(context)))

    @staticmethod
    def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, at, -1)

    def cost(self, codes: np.ndarray) -> np.ndarray:
        """Bits that the last byte of each n-gram takes after the others."""
        codes = codes.astype(np.uint64)
        bits, open_ = np.zeros(len(codes)), np.arange(len(codes))
        gone_n, gone_d = np.zeros(len(codes)), np.zeros(len(codes))     # excluded: count in this context, bytes
        for k in range(ORDER, -1, -1):
            key, n, context, total, distinct = self.levels[k]
            wanted = codes[open_] & np.uint64((1 << (8 * (k + 1))) - 1)
            c = self.find(context, wanted >> np.uint64(8))
            seen = c >= 0
            at = self.find(key, wanted)
            left = np.where(seen, total[c] - gone_n[open_], 0)
            more = np.where(seen, distinct[c] - gone_d[open_], 0)
            hit = at >= 0
            real = seen & (left + more > 0)
            count = np.where(hit, n[at], more)
            bits[open_[real]] += np.log2((left + more)[real]) - np.log2(np.maximum(count[real], 1e-9))
            if k:
                gone_n[open_] = np.where(seen, self.masked[k][c], 0)
                gone_d[open_] = np.where(seen, distinct[c], 0)
            else:
                gone_d[open_] = np.where(seen, distinct[c], 0)
            open_ = open_[~hit]
        bits[open_] += np.log2(np.maximum(256 - gone_d[open_], 1))
        return bits


class Coder:
    """Code lengths of texts in all languages; n-grams met before are kept
    in a table of fixed size."""

    def __init__(self, model: dict):
        self.names = sorted(model)
        self.trees = [ContextTree(*model[x]) for x in self.names]
        self.code = np.full(1 << TABLE_BITS, 0, np.uint32)
        self.used = np.zeros(1 << TABLE_BITS, bool)
        self.bits = np.zeros((1 << TABLE_BITS, len(self.names)), np.float32)

    def costs(self, codes: np.ndarray) -> np.ndarray:
        return np.stack([t.cost(codes) for t in self.trees], axis=1)

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        data = np.frombuffer(b"".join(START + t for t in texts) + START, np.uint8)
        code = grams(data[:-ORDER])
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes + ORDER) - ORDER
        slot = ((code * np.uint32(2654435761)) >> np.uint32(32 - TABLE_BITS)).astype(np.int64)
        new = ~(self.used[slot] & (self.code[slot] == code))
        if new.any():
            fresh = np.unique(code[new])
            at = ((fresh * np.uint32(2654435761)) >> np.uint32(32 - TABLE_BITS)).astype(np.int64)
            self.code[at], self.used[at], self.bits[at] = fresh, True, 0
            mine = self.code[at] == fresh       # of n-grams that share a slot the last one has it
            self.bits[at[mine]] = self.costs(fresh[mine])
        out = np.zeros((len(texts), len(self.names)))
        clash = np.flatnonzero(self.code[slot] != code)
        starts = ends - sizes
        full = sizes > 0
        for j in range(len(self.names)):
            each = self.bits[:, j][slot]
            if len(clash):
                each[clash] = self.trees[j].cost(code[clash])
            # between two texts lie ORDER n-grams of the joint; reduceat takes [start, end) pairs
            pairs = np.stack([starts, ends], axis=1)[full].ravel()
            if len(pairs):
                out[full, j] = np.add.reduceat(np.append(each, np.float32(0)).astype(np.float64), pairs)[::2]
        return out


def train(docs: DataFrame, trainable, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = DOCS_PER_LANGUAGE, max_bytes: int = BYTES_PER_LANGUAGE) -> dict:
    """{language: (n-gram codes, counts)} from at most ``per_language`` whole
    distinct documents of each language, those of the smallest id hash: as
    many of them as start within ``max_bytes``."""
    rows = docs.filter(trainable).filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("g"), F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    texts = common.sample_texts(rows, rows.select("g", "id"), per_language, "language", max_bytes, by_group=True).select(F.col("g").alias("lang"), "t")
    texts = texts.repartition("lang")       # at most max_bytes and a text of each, so that n-grams are counted once a language

    def run(batch: pa.RecordBatch):
        langs = np.array(batch.column(0).to_pylist(), object)
        for lang in sorted(set(langs)):
            own = [START + batch.column(1)[int(i)].as_py().encode("utf-8", "surrogatepass") for i in np.flatnonzero(langs == lang)]
            code, n = np.unique(np.concatenate([grams(np.frombuffer(t, np.uint8)) for t in own]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "code", "n"])

    counts = common.map_batches(texts, run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    lang = np.array(found["lang"].to_pylist(), object)
    code, n = found["code"].to_numpy().astype(np.uint32), found["n"].to_numpy().astype(np.float64)
    return {x: (code[lang == x], n[lang == x]) for x in sorted(set(lang))}


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) per row; score is the winner's share of the
    evidence per byte, 0 for ``und``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        coder = Coder(sent.value) if sent.value else None
        for batch in batches:
            texts = [x.as_py() for x in batch.column(1)]
            pred, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if coder else []
            coded = [texts[i].encode("utf-8", "surrogatepass") for i in known]
            sizes = [len(t) for t in coded]
            for a, b in common.slices(sizes, 1 << 21):
                bits = coder.lengths(coded[a:b])
                gap = (bits - bits.min(axis=1, keepdims=True)) * SCALE
                share = 1 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1)
                for i, j, s in zip(known[a:b], bits.argmin(axis=1), share):
                    pred[i], score[i] = coder.names[j], s
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(pred), pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).mapInArrow(common.trimming(run), "id long, lang_pred string, score double")
