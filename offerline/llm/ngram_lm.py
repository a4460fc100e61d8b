"""Language-model scores from an Elias-Fano n-gram trie.

The model is a trigram model by absolute discounting, interpolated down to
the word frequencies: p = a3 + l3 (a2 + l2 p1), where a is (count - d) / count
of the context and l is d times the context's distinct successors / its count.
Each order has its discount d, ones / (ones + 2 twos) of the order's n-grams
seen once and twice in all shards. N-grams seen once are in the levels like
any other. An unknown word has the mass that discounting takes from the known
ones.

The trie is cut by context word (a frequent one also by the word before it),
so every shard is of bounded size and holds all it needs. A shard's levels --
context words, their successors, pairs of context words, the pairs'
successors -- are monotone sequences in Elias-Fano code, with Elias-Fano
pointers from a node to its children. A successor of a pair is stored as its
place among the successors of the nearer word (it is always one of them),
which keeps the numbers small. Probabilities and weights are quantised to one
byte on a logarithmic scale, whose steps reach the shard's smallest value. A
shard's file is memory-mapped and queried by successor search.

Documents are grouped in blocks. A block sends its distinct words to the
shards that count them, then its distinct trigrams to the trie shards, and
gets one answer for each in the order sent; so texts never move, and a
frequent n-gram travels once a block. The shards read what was sent to them
twice, for the discounts and for the trie, from one shuffle; a lost
executor's part of it is sent again from the stored blocks. Words are known
by 64-bit hashes.

Rows: a null or empty text is the end token alone; repeated rows count and
are scored as often as they occur; without training rows every word is
unknown and has probability one.
"""

from __future__ import annotations

import itertools
import mmap
import pickle
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerline.llm import common

BLOCK_BYTES = 7 << 20      # text of a block
SHARD_BYTES = 7 << 20      # text for each shard of words and of the trie
HASH_BYTES = 1 << 20        # text hashed at once
PER_DECADE = 32             # quantisation steps a factor of ten, fewer where a shard's values reach below 10 ** -7.9
U = np.uint64
BASE = 0x9E3779B97F4A7C55
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
END = U(0xE0D)              # hash of the end token


def _packed(**values) -> bytes:
    """Compressed values; of an array of numbers all lowest bytes come first,
    then the next ones, so that the (mostly empty) high bytes compress."""
    wide = {k: x for k, x in values.items() if isinstance(x, np.ndarray) and x.ndim == 1 and x.itemsize > 1}
    planes = {k: (x.dtype, np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T)) for k, x in wide.items()}
    return zstandard.compress(pickle.dumps((planes, {k: x for k, x in values.items() if k not in wide}), protocol=5), 1)


def _unpacked(data: bytes) -> dict:
    planes, rest = pickle.loads(zstandard.decompress(data))
    return rest | {k: np.ascontiguousarray(x.T).view(dtype).ravel() for k, (dtype, x) in planes.items()}


def steps(*columns: np.ndarray) -> list[np.ndarray]:
    """Sorted rows as differences to the row before: a column's where the
    columns before it are equal, its value elsewhere."""
    same, out = np.arange(len(columns[0])) > 0, []
    for x in columns:
        before = np.concatenate([x[:1], x[:-1]])
        out.append(np.where(same, x - before, x))
        same = same & (x == before)
    return out


def from_steps(*columns: np.ndarray) -> list[np.ndarray]:
    """The rows that ``steps`` was given."""
    same, out = np.arange(len(columns[0])) > 0, []
    for x in columns:
        total = np.cumsum(x)
        first = np.flatnonzero(~same)
        value = total - np.repeat(total[first] - x[first], np.diff(np.append(first, len(x))))
        out.append(value)
        same = same & (value == np.concatenate([value[:1], value[:-1]]))
    return out


def smallest_type(*columns: np.ndarray) -> type:
    return np.uint32 if all(not len(x) or x.max() < 1 << 32 for x in columns) else np.int64


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


# --- words -------------------------------------------------------------------

def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of lower-cased texts, an end token after each
    text, and the number of tokens of each text."""
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    gap = SPACE[data]
    start = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    stop = np.flatnonzero(gap & np.concatenate([[False], ~gap[:-1]]))
    power = np.cumprod(np.concatenate([[U(1)], np.full(len(data), BASE, U)]))
    sums = np.concatenate([[U(0)], np.cumsum((data.astype(U) + U(1)) * power[:-1])])
    back = np.cumprod(np.concatenate([[U(1)], np.full(len(data), INVERSE, U)]))
    word = mix((sums[stop] - sums[start]) * back[start] + (stop - start).astype(U) * U(0xD6E8FEB86659FD93))
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    before = np.searchsorted(start, ends)       # words up to each text's end
    sizes = np.diff(np.concatenate([[0], before])) + 1
    return np.insert(word, before, END), sizes


def blocks_of(batch: pa.RecordBatch, batch_no: int):
    """(name, ids, held, sizes, vocabulary, local token numbers) per block."""
    part = TaskContext.get().partitionId()
    texts = [x.as_py().encode("utf-8", "surrogatepass").lower() for x in batch.column(2)]
    ids, held = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), bool)
    lengths = [len(t) + 1 for t in texts]
    for n, (a, b) in enumerate(common.slices(lengths, BLOCK_BYTES)):
        parts = [hashed_words(texts[a + x:a + y]) for x, y in common.slices(lengths[a:b], HASH_BYTES)]
        tokens, sizes = (np.concatenate(x) for x in zip(*parts))
        vocab, local = np.unique(tokens, return_inverse=True)
        yield f"{part}-{batch_no}-{n}", ids[a:b], held[a:b], sizes, vocab, local.astype(np.uint32)


def each_block(docs: DataFrame, fn, schema: str) -> DataFrame:
    """Rows that ``fn`` makes of each block of (id, held, t)."""
    def run(batches):
        for i, batch in enumerate(batches):
            for block in blocks_of(batch, i):
                yield from fn(*block)

    return docs.mapInArrow(common.trimming(run), schema)


def word_shards(vocab: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The vocabulary's order by shard and hash, and the shards' bounds."""
    shard = (vocab >> U(20)) % U(shards)
    order = np.lexsort((vocab, shard))
    return order, np.searchsorted(shard[order], np.arange(shards + 1, dtype=U))


def count_words(docs: DataFrame, shards: int) -> DataFrame:
    """(block, shard, data, tokens, types, ones, twos): for each block and
    shard the training counts and numbers of the words the block sent, in
    its order; a row without block has the shard's totals."""
    def ask(name, ids, held, sizes, vocab, local):
        train = np.bincount(local, weights=np.repeat(~held, sizes), minlength=len(vocab)).astype(np.int64)
        order, cut = word_shards(vocab, shards)
        rows = [(s, name, _packed(word=vocab[o], n=train[o])) for s in range(shards) if len(o := order[cut[s]:cut[s + 1]])]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()),
                                          pa.array([r[2] for r in rows], pa.binary())], ["shard", "block", "data"])

    def answer(key, frame: pd.DataFrame) -> pd.DataFrame:
        data = [_unpacked(x) for x in frame["data"]]
        word, at = np.unique(np.concatenate([d["word"] for d in data]), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([d["n"] for d in data])).astype(np.int64)
        number = np.empty(len(n), np.int64)
        number[np.argsort(-n, kind="stable")] = np.arange(len(n))
        number = number * shards + int(key[0]) + 1     # 0 is the start of a text
        ends = np.cumsum([len(d["word"]) for d in data])
        rows = [(b, int(key[0]), _packed(n=n[own], number=number[own].astype(np.uint32 if number.max() < 1 << 32 else np.uint64)), 0, 0, 0, 0)
                for b, own in zip(frame["block"], np.split(at, ends[:-1]))]
        rows.append((None, int(key[0]), None, int(n.sum()), int((n > 0).sum()), int((n == 1).sum()), int((n == 2).sum())))
        return pd.DataFrame(rows, columns=["block", "shard", "data", "tokens", "types", "ones", "twos"])

    asked = each_block(docs, ask, "shard int, block string, data binary")
    return asked.groupBy("shard").applyInPandas(common.trimming_groups(answer), "block string, shard int, data binary, tokens long, types long, ones long, twos long")


# --- the trie ------------------------------------------------------------------

class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary."""

    def __init__(self, low: np.ndarray, high: np.ndarray, width: int, size: int):
        self.low, self.width, self.size = low, width, size
        zeros = np.flatnonzero(np.unpackbits(high) == 0)
        self.until = zeros - np.arange(len(zeros))      # elements up to each bucket's end

    @staticmethod
    def code(values: np.ndarray, universe: int) -> dict:
        n = len(values)
        width = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        values = values.astype(U)
        bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, count=width, bitorder="little") if width else np.zeros((n, 0), np.uint8)
        top = (values >> U(width)).astype(np.int64)
        unary = np.zeros(n + (universe >> width) + 2, np.uint8)
        unary[top + np.arange(n)] = 1
        return {"low": np.concatenate([np.packbits(bits.ravel(), bitorder="little"), np.zeros(9, np.uint8)]),
                "high": np.packbits(np.concatenate([unary, np.ones(-len(unary) % 8, np.uint8)])), "width": width, "size": n}

    def lows(self, at: np.ndarray) -> np.ndarray:
        bit = at * self.width
        byte, shift = bit >> 3, (bit & 7).astype(U)
        # Eight bytes from each byte on, and the ninth where a value may reach into it.
        out = np.ndarray(len(self.low) - 8, "<u8", self.low, strides=(1,))[byte] >> shift
        if self.width > 57:
            out |= np.where(shift > 0, self.low[byte + 8].astype(U) << ((U(64) - shift) & U(63)), U(0))
        return out & U((1 << self.width) - 1)

    def values(self) -> np.ndarray:
        top = np.repeat(np.arange(len(self.until)), np.diff(np.concatenate([[0], self.until])))[:self.size]
        return (top.astype(U) << U(self.width)) | self.lows(np.arange(self.size))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each wanted value, -1 where there is none: the bucket
        of its high bits, then successor search among the low bits. Each is
        looked up once, in order, which keeps the reads close together."""
        wanted, own = np.unique(wanted, return_inverse=True)
        top = (wanted >> U(self.width)).astype(np.int64)
        ok = top < len(self.until)
        top = np.where(ok, top, 0)
        lo, hi = np.where(top > 0, self.until[top - 1], 0), self.until[top]
        lo, hi = np.where(ok, lo, 0), np.where(ok, hi, 0)
        end, rest = hi.copy(), wanted & U((1 << self.width) - 1)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.lows(mid) < rest[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
            open_ = open_[lo[open_] < hi[open_]]
        found = lo < end
        found[found] = self.lows(lo[found]) == rest[found]
        return np.where(found, lo, -1)[own]


def scale(*levels: np.ndarray) -> float:
    """Steps a factor of ten, such that the smallest value above zero of all
    ``levels`` has a step of its own."""
    lowest = min((float(p[p > 0].min()) for p in levels if (p > 0).any()), default=1.0)
    return min(float(PER_DECADE), 253 / max(-np.log10(lowest), 1e-9))


def quantised(p: np.ndarray, per_decade: float) -> np.ndarray:
    """One byte a probability, rounded down; 0 for zero."""
    safe = np.where(p > 0, p, 1.0)
    return np.where(p > 0, 1 + np.ceil(-np.log10(safe) * per_decade - 1e-9), 0).astype(np.uint8)


def values_of(codes: np.ndarray, per_decade: float) -> np.ndarray:
    """The probabilities of ``quantised`` bytes."""
    return np.concatenate([[0.0], 10.0 ** (-np.arange(255) / per_decade)])[codes]


def grouped(n: np.ndarray, *keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct key rows in order, and the sums of ``n``. Columns are joined
    to one number; where two don't fit 63 bits, their ranks are."""
    if not len(n):
        return list(keys), n
    key = keys[0].astype(np.int64)
    for k in keys[1:]:
        k = k.astype(np.int64)
        if int(key.max()).bit_length() + int(k.max()).bit_length() > 63:
            key = np.unique(key, return_inverse=True)[1]
        if int(key.max()).bit_length() + int(k.max()).bit_length() > 63:
            k = np.unique(k, return_inverse=True)[1]
        key = (key << int(k.max()).bit_length()) | k
    order = np.argsort(key)
    sorted_ = key[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    return [k[order[first]] for k in keys], np.add.reduceat(n[order], first)


def runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal rows begin, and of each row the number of its run."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in columns], axis=0)
    return np.flatnonzero(new), np.cumsum(new) - 1


class TrieShard:
    """Levels of one shard. Sequences: ``near`` (context words), ``next``
    (their successors, word + U times the parent's place), ``pair`` (words
    before, likewise) and ``far`` (the pairs' successors as places among the
    near word's successors); ``next_at`` has the pointers into ``next``."""

    def __init__(self, file):
        view = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        size = int.from_bytes(view[:8], "little")
        shape = pickle.loads(view[8:8 + size])
        take = lambda at, n: np.frombuffer(view, np.uint8, n, 8 + size + at)
        self.universe, self.span, self.per_decade = shape["universe"], shape["span"], shape["per_decade"]
        self.codes = {k: take(*shape["codes"][k]) for k in shape["codes"]}
        self.seq = {k: EliasFano(take(*s["low"]), take(*s["high"]), s["width"], s["size"]) for k, s in shape["seq"].items()}
        self.next_at = self.seq["next_at"].values().astype(np.int64)

    @staticmethod
    def write(file, tri: tuple, bi: tuple, d3: float, d2: float) -> None:
        """Build from (nearer word, word before, word, count) and, for the
        words in it, (nearer word, word, count), counts above zero; ``d3``
        and ``d2`` are the discounts of trigrams and bigrams."""
        (t1, t2, tw), tn = grouped(tri[3], *tri[:3])
        (b1, bw), bn = grouped(bi[2], *bi[:2])
        universe = int(max([0, *(int(x.max()) for x in (t1, t2, tw, b1, bw) if len(x))])) + 1
        near, at, types = np.unique(b1, return_inverse=True, return_counts=True)
        total = np.bincount(at, weights=bn, minlength=len(near))
        next_at = np.concatenate([[0], np.cumsum(types)]).astype(np.int64)
        next_key = at.astype(U) * U(universe) + bw.astype(U)
        place = np.searchsorted(near, t1)
        pair_key = place.astype(U) * U(universe) + t2.astype(U)
        pair, own, kinds = np.unique(pair_key, return_inverse=True, return_counts=True)
        pair_total = np.bincount(own, weights=tn, minlength=len(pair))
        child = np.searchsorted(next_key, place.astype(U) * U(universe) + tw.astype(U)) - next_at[place]
        span = int(child.max()) + 1 if len(child) else 1
        far = own.astype(U) * U(span) + child.astype(U)
        order = np.argsort(far, kind="stable")
        seqs = {"near": (near, universe), "next": (next_key, universe * max(1, len(near))), "next_at": (next_at, len(next_key) + 1),
                "pair": (pair, universe * max(1, len(near))), "far": (far[order], span * max(1, len(pair)))}
        levels = {"near": d2 * types / np.maximum(total, 1), "next": (bn - d2) / total[at],
                  "pair": d3 * kinds / np.maximum(pair_total, 1), "far": ((tn - d3) / pair_total[own])[order]}
        per_decade = scale(*levels.values())
        codes = {k: quantised(p, per_decade) for k, p in levels.items()}
        shape, body, offset = {"universe": universe, "span": span, "per_decade": per_decade, "seq": {}, "codes": {}}, [], 0

        def put(x):
            nonlocal offset
            body.append(x.tobytes())
            offset += len(x)
            return offset - len(x), len(x)

        for k, (values, top) in seqs.items():
            c = EliasFano.code(values, int(top))
            shape["seq"][k] = {"low": put(c["low"]), "high": put(c["high"]), "width": c["width"], "size": c["size"]}
        for k, x in codes.items():
            shape["codes"][k] = put(x)
        head = pickle.dumps(shape)
        file.write(len(head).to_bytes(8, "little") + head + b"".join(body))
        file.flush()

    def query(self, h1: np.ndarray, h2: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Codes (a3, l3, a2, l2) of each trigram; l is 1 (probability one)
        where the context is unknown."""
        out = np.zeros((4, len(w)), np.uint8)
        out[1] = out[3] = 1
        first, own = runs(h1)       # messages come in order: a context is looked up once a run
        n1 = self.seq["near"].find(h1[first].astype(U))[own]
        has = np.flatnonzero(n1 >= 0)
        out[3, has] = self.codes["near"][n1[has]]

        def below(level, at, word):     # words beyond the universe are in no level
            inside = word < self.universe
            found = self.seq[level].find(at.astype(U) * U(self.universe) + np.where(inside, word, 0).astype(U))
            return np.where(inside, found, -1)

        child = below("next", n1[has], w[has])
        first, own = runs(n1[has], h2[has])
        pair = below("pair", n1[has][first], h2[has][first])[own]
        out[2, has[child >= 0]] = self.codes["next"][child[child >= 0]]
        out[1, has[pair >= 0]] = self.codes["pair"][pair[pair >= 0]]
        both = np.flatnonzero((pair >= 0) & (child >= 0))
        relative = child[both] - self.next_at[n1[has[both]]]
        in_span = relative < self.span
        both, relative = both[in_span], relative[in_span]
        far = self.seq["far"].find(pair[both].astype(U) * U(self.span) + relative.astype(U))
        out[0, has[both[far >= 0]]] = self.codes["far"][far[far >= 0]]
        return out


# --- trigrams --------------------------------------------------------------------

def distinct_rows(h1: np.ndarray, h2: np.ndarray, w: np.ndarray, bits: int, room: int = 63) -> tuple:
    """The distinct rows of three numbers below 2 ** bits in order, and of each
    row its place among them; in two steps where ``room`` bits don't hold
    three numbers."""
    mask = (1 << bits) - 1
    if 3 * bits <= room:
        key, at = np.unique((h1 << (2 * bits)) | (h2 << bits) | w, return_inverse=True)
        return key >> (2 * bits), key >> bits & mask, key & mask, at
    pair, own = np.unique((h1 << bits) | h2, return_inverse=True)
    key, at = np.unique((own << bits) | w, return_inverse=True)
    both = pair[key >> bits]
    return both >> bits, both & mask, key & mask, at


class Trigrams:
    """The distinct trigrams of a block by trie shard, each shard's in the
    order of their word numbers, and of each token the number of its trigram."""

    def __init__(self, block: dict, number: np.ndarray, count: np.ndarray, shards: int, tokens: int):
        sizes, none = block["sizes"], len(number)      # none: the start of a text, number 0
        number = np.append(number.astype(np.int64), 0)
        count = np.append(count, count[np.searchsorted(block["vocab"], END)])
        by = np.argsort(number)         # words by number: their places stand for them
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        number, count, local = number[by], count[by], place[block["local"]]
        first = np.cumsum(sizes) - sizes
        h1 = np.concatenate([[0], local[:-1]])
        h1[first] = 0
        h2 = np.concatenate([[0], h1[:-1]])
        h2[first] = 0
        parts = 1 + 2 * shards * count // max(1, tokens)    # shards a context word is dealt to
        l1, l2, lw, self.of_token = distinct_rows(h1, h2, local, none.bit_length())
        self.word = by[lw]
        home = mix(number[l1].astype(U)) % U(shards)
        shard = (home + mix(number[l2].astype(U) + U(7)) % np.minimum(parts[l1], shards).astype(U)) % U(shards)
        self.order = np.argsort(shard, kind="stable")
        self.cut = np.searchsorted(shard[self.order], np.arange(shards + 1, dtype=U))
        self.h1, self.h2, self.w = number[l1], number[l2], number[lw]
        self.n = np.bincount(self.of_token, weights=np.repeat(~block["held"], sizes), minlength=len(lw)).astype(np.int64)
        # Pairs after the context words that are dealt to several shards go to all of them.
        often = np.flatnonzero((parts[l1] > 1) & (self.n > 0))
        (c1, cw), cn = grouped(self.n[often], l1[often], lw[often])
        times = np.minimum(parts[c1], shards)
        row = np.repeat(np.arange(len(c1)), times)
        step = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        to = (mix(number[c1[row]].astype(U)) % U(shards) + step.astype(U)) % U(shards)
        go = np.argsort(to, kind="stable")
        self.pair_cut = np.searchsorted(to[go], np.arange(shards + 1, dtype=U))
        row = row[go]
        self.pairs = number[c1[row]], number[cw[row]], cn[row]

    def messages(self):
        for s in range(len(self.cut) - 1):
            o, p = self.order[self.cut[s]:self.cut[s + 1]], slice(self.pair_cut[s], self.pair_cut[s + 1])
            if len(o) or p.start < p.stop:
                tri, pair = steps(self.h1[o], self.h2[o], self.w[o]), steps(self.pairs[0][p], self.pairs[1][p])
                small = smallest_type(*tri, *pair)
                yield s, _packed(h1=tri[0].astype(small), h2=tri[1].astype(small), w=tri[2].astype(small), n=self.n[o].astype(np.uint32),
                                 p1=pair[0].astype(small), pw=pair[1].astype(small), pn=self.pairs[2][p].astype(np.uint32))


def joined_words(block: dict, answers: list, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and training counts of a block's vocabulary."""
    order, cut = word_shards(block["vocab"], shards)
    number, count = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    for a in answers:
        d, s = _unpacked(a["data"]), a["shard"]
        number[order[cut[s]:cut[s + 1]]] = d["number"]
        count[order[cut[s]:cut[s + 1]]] = d["n"]
    return number, count


def received(messages: list[bytes]) -> tuple:
    """Trigrams and their counts as the blocks sent them to a shard, the
    training trigrams and bigrams among them, which of the bigrams came
    counted, and the number of trigrams of each message."""
    data = [_unpacked(x) for x in messages]
    column = lambda d, *names: [d[x].astype(np.int64) for x in names]
    h1, h2, w, n = map(np.concatenate, zip(*[(*from_steps(*column(d, "h1", "h2", "w")), *column(d, "n")) for d in data]))
    p1, pw, pn = map(np.concatenate, zip(*[(*from_steps(*column(d, "p1", "pw")), *column(d, "pn")) for d in data]))
    seen = n > 0
    own = seen & ~np.isin(h1, np.unique(p1))        # words whose pairs all lie here
    bi = tuple(np.concatenate(x) for x in ((p1, h1[own]), (pw, w[own]), (pn, n[own])))
    return (h1, h2, w), (h1[seen], h2[seen], w[seen], n[seen]), bi, np.arange(len(bi[0])) < len(p1), [len(d["w"]) for d in data]


def each_shard(rows):
    """(shard, blocks, messages) of rows (shard, block, data) in shard order."""
    for shard, group in itertools.groupby(rows, key=lambda r: r["shard"]):
        names, messages = zip(*[(r["block"], r["data"]) for r in group])
        yield shard, names, messages
        common.release()


def seen_once_and_twice(sent: RDD, shards: int) -> tuple[int, int, int, int]:
    """How many trigrams, then bigrams, the training rows hold once and twice.
    A bigram that went to several shards counts in the first."""
    def run(rows):
        for shard, _, messages in each_shard(rows):
            _, tri, bi, dealt, _ = received(messages)
            here = ~dealt | (mix(bi[0].astype(U)) % U(shards) == U(shard))
            n3, n2 = grouped(tri[3], *tri[:3])[1], grouped(bi[2][here], bi[0][here], bi[1][here])[1]
            yield tuple(int((n == k).sum()) for n in (n3, n2) for k in (1, 2))

    add = lambda a, b: tuple(x + y for x, y in zip(a, b))
    return sent.mapPartitions(run).treeAggregate((0, 0, 0, 0), add, add)


def answer_trigrams(sent: RDD, d3: float, d2: float) -> RDD:
    """(block, shard, data): builds each shard's trie from the training counts
    and looks up what the blocks sent."""
    def run(rows):
        for shard, names, messages in each_shard(rows):
            asked, tri, bi, _, sizes = received(messages)
            with tempfile.TemporaryFile() as file:
                TrieShard.write(file, tri, bi, d3, d2)
                trie = TrieShard(file)
                codes = trie.query(*asked)
            for name, own in zip(names, np.split(codes, np.cumsum(sizes)[:-1], axis=1)):
                yield name, shard, _packed(codes=own, per_decade=trie.per_decade)

    return sent.mapPartitions(run)


def discount_of(ones: int, twos: int) -> float:
    return ones / (ones + 2 * twos) if ones else 0.5


def scores(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per
    row; ``training`` says which rows are learned from."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), (~F.coalesce(training, F.lit(False))).alias("held"), common.text_of(text_col).alias("t"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t") + 1), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-size // SHARD_BYTES))
    counted = common.materialize(count_words(rows, shards), "words")
    sums = counted.filter("block is null").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "types", "ones", "twos")]).first()
    total, types, ones, twos = sums["tokens"], sums["types"], sums["ones"], sums["twos"]
    discount = discount_of(ones, twos)

    def store(name, ids, held, sizes, vocab, local):
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([_packed(ids=ids, held=held, sizes=sizes, vocab=vocab, local=local)], pa.binary())], ["block", "tokens"])

    stored = each_block(rows, store, "block string, tokens binary")
    words = counted.filter("block is not null").groupBy("block").agg(F.collect_list(F.struct("shard", "data")).alias("words"))
    known = common.materialize(stored.join(words.hint("shuffle_hash"), "block"), "blocks")

    def ask(batch: pa.RecordBatch):
        for i in range(batch.num_rows):
            block = _unpacked(batch.column(1)[i].as_py())
            number, count = joined_words(block, batch.column(2)[i].as_py(), shards)
            out = list(Trigrams(block, number, count, shards, total).messages())
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.int32()), pa.array([batch.column(0)[i].as_py()] * len(out), pa.string()),
                                              pa.array([d for _, d in out], pa.binary())], ["shard", "block", "data"])

    asked = common.map_batches(known.select("block", "tokens", "words"), ask, "shard int, block string, data binary")
    # One RDD for both readings: the second one finds the first one's shuffle files.
    sent = asked.repartition("shard").sortWithinPartitions("shard").rdd
    ones3, twos3, ones2, twos2 = seen_once_and_twice(sent, shards)
    looked = docs.sparkSession.createDataFrame(answer_trigrams(sent, discount_of(ones3, twos3), discount_of(ones2, twos2)),
                                               "block string, shard int, data binary", verifySchema=False)
    found = looked.groupBy("block").agg(F.collect_list(F.struct("shard", "data")).alias("found"))

    def add(batch: pa.RecordBatch):
        for i in range(batch.num_rows):
            block = _unpacked(batch.column(1)[i].as_py())
            number, count = joined_words(block, batch.column(2)[i].as_py(), shards)
            own = Trigrams(block, number, count, shards, total)
            found = np.zeros((4, len(own.w)))
            for a in batch.column(3)[i].as_py():
                s, d = a["shard"], _unpacked(a["data"])
                found[:, own.order[own.cut[s]:own.cut[s + 1]]] = values_of(d["codes"], d["per_decade"])
            a3, l3, a2, l2 = found
            c = count[own.word]
            lowest = np.where(c > 0, c - discount, discount * types) / total if total else np.ones(len(c))
            logs = np.log10(a3 + l3 * (a2 + l2 * lowest))[own.of_token]
            base = np.log10((count + 1) / (total + types + 1))[block["local"]]
            at = np.cumsum(block["sizes"]) - block["sizes"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block["ids"], pa.int64()), pa.array(block["held"]), pa.array(block["sizes"].astype(np.int64)),
                 pa.array(np.add.reduceat((count > 0)[block["local"]].astype(np.int64), at)), pa.array(np.full(len(at), total, np.int64)),
                 pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(logs, at))],
                ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return common.map_batches(known.join(found.hint("shuffle_hash"), "block").select("block", "tokens", "words", "found"), add,
                              "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
