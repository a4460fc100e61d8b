"""Token ids of whole texts by the tokenizers library, a piece at a time.

A byte-pair tokenizer encodes the pieces of its pre-tokenizer independently,
and texts repeat most words. A text is therefore cut where the library
itself always cuts -- at single blanks between visible characters, and
between Latin letters and ASCII punctuation -- each distinct piece is encoded
once by the library, each distinct word keeps its ids, and the ids are put
together again. Arrow splits some texts at once and finds their distinct
words, which are looked up as rows of a numpy array. Texts with any other use of white
space around a blank, or with a NUL character, are encoded whole.
"""

from __future__ import annotations

import codecs
import functools
import itertools
import operator
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from offerline.llm.common import slices

# Between a Latin letter and ASCII punctuation (no apostrophe), either way.
LETTERS, MARKS = "A-Za-zß-öø-ÿ", "!-&(-/:-@\\[-`{-~"
CUT = re.compile(f"(?<=[{LETTERS}])(?=[{MARKS}])|(?<=[{MARKS}])(?=[A-Za-z])")
# A run of Latin letters, with the blank before it or not: one piece for the model.
PLAIN = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
PLAIN_WORD = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
# Such a word and the marks behind it, where it is cut once.
MARKED_WORD = f"^[A-Za-zÀ-ÖØ-öø-ÿ]*[{LETTERS}][{MARKS}]+$"
TAIL = "".join(filter(re.compile(f"[{MARKS}]").match, map(chr, range(128))))
# The byte-level alphabet: visible Latin-1 characters stand for themselves, the other bytes for U+0100 on.
VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
ALPHABET = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in VISIBLE)}
SHOWN = "".join(ALPHABET.get(b, chr(b)) for b in range(256))    # what the model sees of each byte
JOINT = "\xc0"      # stands for a byte that UTF-8 never has
WORDS_AT_ONCE = 32      # joined for one call of the model
KEY_BYTES = 24      # words of up to so many bytes are found in an array, longer ones in a dict
MEMO_WORDS, MEMO_PIECES = 800_000, 100_000    # kept by a worker; beyond it those used least are forgotten, which costs time only
TEXT_AT_ONCE = 1 << 20      # the working arrays of a call are many times its texts
ENCODE_AT_ONCE = 20_000


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True     # their strings in a text are ordinary text
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        probe = "x" if self.normalizer is None else self.normalizer.normalize_str("x")
        cut = [x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(" " + probe)]
        self.keeps_blank = {("Ġx",): True, ("x",): False}.get(tuple(cut))      # else no short cut
        # Many pieces are normalised in one call if that changes nothing.
        words = [" x", "Ab", " éÈ", "ß", " Öÿ", "x"] if self.keeps_blank else ["x", "Ab", "éÈ", "ß", "Öÿ", "x"]
        self.between = None
        for mark in ("\n",) if self.keeps_blank else ("\n", " "):
            if self.normalizer is not None and self.normalizer.normalize_str(mark.join(words)).split(mark) == [self.normalizer.normalize_str(w) for w in words]:
                self.between = mark
        # Words are joined for the model by a symbol that no merge knows, where it takes no word's end into account.
        self.joint = None
        if (self.keeps_blank and self.normalizer is None and not any((self.model.end_of_word_suffix, self.model.continuing_subword_prefix,
                self.model.unk_token, self.model.dropout, self.model.ignore_merges))
                and [t for t in self.tokenizer.get_vocab(with_added_tokens=False) if JOINT in t] == [JOINT]):
            self.joint = self.model.token_to_id(JOINT)
        self.clear()

    def clear(self) -> None:
        self.pieces_known = Memo()
        self.words_known = Words()

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(texts), ENCODE_AT_ONCE):
            out += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts[i:i + ENCODE_AT_ONCE], add_special_tokens=False)]
        return out

    def pieces(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each piece."""
        plain = [p for p in pieces if PLAIN.fullmatch(p)] if self.keeps_blank is not None else []
        own = set(plain)
        other = [p for p in pieces if p not in own]
        found = dict(zip(other, (e.ids for e in self.tokenizer.encode_batch_fast(other, add_special_tokens=False))))
        ids, sizes = self.letters(plain)
        ends = np.cumsum(sizes).tolist()
        flat = ids.tolist()
        found.update(zip(plain, (flat[a:b] for a, b in zip([0, *ends], ends))))
        return [found[p] for p in pieces]

    def letters(self, plain: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs of Latin letters one after another, and how many
        each has. They go to the library's model directly, as its
        pre-tokenizer would hand them over."""
        if not plain:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        tokenize, number = self.model.tokenize, operator.attrgetter("id")
        if self.joint is not None:
            table = SHOWN[:10] + JOINT + SHOWN[11:]
            parts = (codecs.charmap_decode(("\n".join(plain[i:i + WORDS_AT_ONCE]) + "\n").encode(), "strict", table)[0]
                     for i in range(0, len(plain), WORDS_AT_ONCE))
            ids = np.fromiter((t for part in parts for t in map(number, tokenize(part))), np.uint32)
            joints = ids == self.joint
            return ids[~joints], np.diff(np.flatnonzero(joints), prepend=-1) - 1
        shown = plain if self.keeps_blank else [p.lstrip(" ") for p in plain]
        if self.between is not None:
            shown = self.normalizer.normalize_str(self.between.join(shown)).split(self.between)
        elif self.normalizer is not None:
            shown = [self.normalizer.normalize_str(p) for p in shown]
        shown = codecs.charmap_decode("\n".join(shown).encode(), "strict", SHOWN[:10] + "\n" + SHOWN[11:])[0].split("\n")
        found = [list(map(number, tokenize(x))) for x in shown]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def lookup(self, words: pa.StringArray) -> np.ndarray:
        """The codes of distinct words; new ones are learned."""
        codes, keys, short = np.full(len(words), -1), *packed(words)
        known = self.words_known
        codes[short] = known.find(keys[short])
        long = np.flatnonzero(~short)
        if len(long):
            codes[long] = np.fromiter(map(known.index.get, words.take(pa.array(long)).to_pylist(), itertools.repeat(-1)), np.int64, len(long))
        missing = np.flatnonzero(codes < 0)
        fresh = words.take(pa.array(missing))
        plain, marked = (np.zeros(len(fresh), bool) if self.keeps_blank is None
                         else pc.match_substring_regex(fresh, pattern).to_numpy(zero_copy_only=False) for pattern in (PLAIN_WORD, MARKED_WORD))
        # The plain ones first: marked ones are looked up without their marks.
        for own, ids_of in ((plain, self.letter_words), (marked, self.marked_words), (~(plain | marked), self.cut_words)):
            places, texts = missing[own], fresh.filter(pa.array(own)).to_numpy(zero_copy_only=False)
            for i in range(0, len(places), ENCODE_AT_ONCE):
                at, part = places[i:i + ENCODE_AT_ONCE], texts[i:i + ENCODE_AT_ONCE].tolist()
                codes[at] = known.add(part, *ids_of(part), keys[at], short[at])
        return codes

    def letter_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, bool]:
        return *self.letters([" " + w for w in words]), False

    def marked_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, bool]:
        """The ids of new words that end with marks: those of the word alone
        and of its marks."""
        bare = [w.rstrip(TAIL) for w in words]
        coded = pa.array(bare, pa.string()).dictionary_encode()
        ids, sizes = self.words_known.take(self.lookup(coded.dictionary)[coded.indices.to_numpy()])
        tails = [w[len(b):] for w, b in zip(words, bare)]
        self.learn(tails)
        tail_ids, tail_sizes = self.pieces_known.take(np.fromiter(map(self.pieces_known.index.get, tails), np.int64, len(tails)))
        both = sizes + tail_sizes
        starts = np.cumsum(both) - both
        out = np.zeros(int(both.sum()), np.uint32)
        out[_ranges(starts, sizes)] = ids
        out[_ranges(starts + sizes, tail_sizes)] = tail_ids
        return out, both, False

    def learn(self, pieces: Iterable[str]) -> None:
        """Keep the ids of those pieces that are new."""
        known = self.pieces_known.index
        fresh = list(dict.fromkeys(p for p in pieces if p not in known))
        if fresh:
            ids = self.pieces(fresh)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self.pieces_known.add(fresh, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes)

    def cut_words(self, words: list) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """The ids of new words, cut into pieces; a tuple holds a text's first word, which
        has no blank before it. Words that do not stand for themselves are
        marked."""
        cuts, bad = [], []
        for word in words:
            at_start = isinstance(word, tuple)
            shown = word[0] if at_start else word
            if shown.isalpha():     # nowhere to cut
                bad.append(False)
                cuts.append([shown if at_start else " " + shown])
                continue
            bad.append((not shown and not at_start) or "\0" in shown or (shown != "" and (shown[0].isspace() or shown[-1].isspace())))
            cuts.append(CUT.split(shown if at_start else " " + shown) if shown and not bad[-1] else [])
        self.learn(p for cut in cuts for p in cut)
        known = self.pieces_known.index
        counts = np.fromiter(map(len, cuts), np.int64, len(cuts))
        codes = np.fromiter((known[p] for cut in cuts for p in cut), np.int64, int(counts.sum()))
        ids, sizes = self.pieces_known.take(codes)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
        return ids, np.diff(ends, prepend=0), bad

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text."""
        return [ids for a, b in slices([len(t) for t in texts], TEXT_AT_ONCE) for ids in self._encode(texts[a:b])]

    def encode_column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """uint32 ids of each text. A column of any size: only some texts are
        held as Python strings at once, and only their ids."""
        for a, b in slices(pc.binary_length(texts).to_pylist(), TEXT_AT_ONCE):
            yield from self._encode(texts.slice(a, b - a).to_pylist())

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.words_known.n > MEMO_WORDS:
            self.words_known = self.words_known.often(MEMO_WORDS // 2)
        if self.pieces_known.n > MEMO_PIECES:
            self.pieces_known = self.pieces_known.often(MEMO_PIECES // 2)
        lists = pc.split_pattern(pa.array(texts, pa.string()), " ")
        counts = lists.value_lengths().to_numpy().astype(np.int64)
        words = lists.flatten()
        ends = np.cumsum(counts)
        firsts = ends - counts
        coded = words.dictionary_encode()
        distinct, places = coded.dictionary, coded.indices.to_numpy()
        # A text's first word is another word than the same one behind a blank.
        inner = np.bincount(places, minlength=len(distinct)) > np.bincount(places[firsts], minlength=len(distinct))
        codes = np.full(len(distinct), -1)
        codes[inner] = self.lookup(distinct.filter(pa.array(inner)))
        codes = codes[places]
        leads = [(w,) for w in words.take(pa.array(firsts)).to_pylist()]
        index = self.words_known.index
        fresh = list(dict.fromkeys(w for w in leads if w not in index))
        if fresh:
            self.words_known.add(fresh, *self.cut_words(fresh))
        codes[firsts] = [index[w] for w in leads]
        slow = np.logical_or.reduceat(self.words_known.bad[codes], firsts)
        ids, sizes = self.words_known.take(codes)
        stops = np.cumsum(sizes)[ends - 1].tolist()
        out = [ids[a:b] for a, b in zip([0, *stops], stops)]
        again = np.flatnonzero(slow).tolist()
        for i, whole in zip(again, self.whole([texts[i] for i in again])):
            out[i] = whole
        return out


class Memo:
    """Ids by key, one after another in one array."""

    def __init__(self):
        self.index: dict = {}
        self.n = self.used = 0
        self.size, self.start = np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int64)
        self.bad = np.zeros(1 << 12, bool)
        self.uses = np.zeros(1 << 12, np.int32)
        self.ids = np.zeros(1 << 14, np.uint32)

    def add(self, keys: list, ids: np.ndarray, sizes: np.ndarray, bad=False) -> np.ndarray:
        """The keys' codes."""
        codes = self.store(ids, sizes, bad)
        self.index.update(zip(keys, codes.tolist()))
        return codes

    def store(self, ids: np.ndarray, sizes: np.ndarray, bad) -> np.ndarray:
        n, end = self.n, self.n + len(sizes)
        self.size, self.start, self.bad, self.uses = (_room(x, end) for x in (self.size, self.start, self.bad, self.uses))
        self.ids = _room(self.ids, self.used + len(ids))
        self.size[n:end] = sizes
        self.start[n:end] = self.used + np.cumsum(sizes) - sizes
        self.bad[n:end] = bad
        self.ids[self.used:self.used + len(ids)] = ids
        self.used, self.n = self.used + len(ids), end
        return np.arange(n, end)

    def take(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the keys one after another, and how many each has."""
        sizes = self.size[codes].astype(np.int64)
        if len(codes):
            used = np.bincount(codes)
            self.uses[:len(used)] += used.astype(np.int32)
        return self.ids[_ranges(self.start[codes], sizes)], sizes

    def often(self, most: int) -> Memo:
        """A memo of the keys used more than once, of at most ``most`` the
        most used."""
        uses = self.uses[:self.n]
        least = 2 if most >= self.n else max(2, int(np.partition(uses, self.n - most)[self.n - most]) + 1)
        kept, out = np.flatnonzero(uses >= least), type(self)()
        out.store(self.ids[_ranges(self.start[kept], self.size[kept].astype(np.int64))], self.size[kept].astype(np.int64), self.bad[kept])
        code = np.full(self.n, -1)
        code[kept] = np.arange(len(kept))
        out.index = {k: c for k, c in zip(self.index, code[list(self.index.values())].tolist()) if c >= 0} if self.index else {}
        self.hand_over(out, kept)
        return out

    def hand_over(self, out: Memo, kept: np.ndarray) -> None:
        pass


class Words(Memo):
    """Ids by word. A word of up to ``KEY_BYTES`` bytes without a NUL is the
    row of an array that holds just its bytes; a hash of the row tells where
    among ``slots`` its code stands, or in the next free ones behind it."""

    def __init__(self):
        super().__init__()
        self.keys = np.zeros((1 << 12, KEY_BYTES // 8), np.uint64)
        self.has_key = np.zeros(1 << 12, bool)
        self.slots = np.full(1 << 13, -1, np.int32)

    def add(self, keys: list, ids: np.ndarray, sizes: np.ndarray, bad=False, rows: np.ndarray | None = None, short: np.ndarray | None = None) -> np.ndarray:
        codes = self.store(ids, sizes, bad)
        self.keys, self.has_key = _room(self.keys, self.n), _room(self.has_key, self.n)
        if short is None:
            short = np.zeros(len(keys), bool)
        self.index.update((keys[i], int(codes[i])) for i in np.flatnonzero(~short).tolist())
        if short.any():
            self.keys[codes[short]] = rows[short]
            self.has_key[codes[short]] = True
            self.place(codes[short])
        return codes

    def at(self, rows: np.ndarray) -> np.ndarray:
        """The first slot of each row."""
        h = np.zeros(len(rows), np.uint64)
        for column in rows.T:
            h = (h ^ column) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return (h & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def find(self, rows: np.ndarray) -> np.ndarray:
        """The code of each row, -1 if new."""
        out, left, at = np.full(len(rows), -1), np.arange(len(rows)), self.at(rows)
        while len(left):
            code = self.slots[at]
            taken = code >= 0
            left, at, code = left[taken], at[taken], code[taken]
            same = (self.keys[code] == rows[left]).all(axis=1)
            out[left[same]] = code[same]
            left, at = left[~same], (at[~same] + 1) & (len(self.slots) - 1)
        return out

    def place(self, codes: np.ndarray) -> None:
        """Enter the new distinct rows of these codes."""
        if 2 * self.n > len(self.slots):
            self.slots = np.full(4 * len(self.slots) if self.n < len(self.slots) else 1 << (4 * self.n).bit_length(), -1, np.int32)
            codes = np.flatnonzero(self.has_key[:self.n])
        at = self.at(self.keys[codes])
        while len(codes):
            free = self.slots[at] < 0
            self.slots[at[free]] = codes[free]
            out = self.slots[at] != codes       # taken before, or by another of these
            codes, at = codes[out], (at[out] + 1) & (len(self.slots) - 1)

    def hand_over(self, out: Words, kept: np.ndarray) -> None:
        out.keys, out.has_key = _room(out.keys, out.n), _room(out.has_key, out.n)
        out.keys[:out.n], out.has_key[:out.n] = self.keys[kept], self.has_key[kept]
        out.place(np.flatnonzero(out.has_key[:out.n]))


def packed(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes as rows of an array, zeros behind them, and which
    words such a row tells from all others."""
    n = len(words)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + n + 1].astype(np.int64)
    data = np.zeros(ends[-1] - ends[0] + KEY_BYTES, np.uint8)
    if ends[-1] > ends[0]:
        data[:ends[-1] - ends[0]] = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    sizes = np.diff(ends)
    rows = np.lib.stride_tricks.sliding_window_view(data, KEY_BYTES)[ends[:-1] - ends[0]]
    short = sizes <= KEY_BYTES
    inside = np.arange(KEY_BYTES) < sizes[:, None]
    if not data[:ends[-1] - ends[0]].all():
        short &= ~((rows == 0) & inside).any(axis=1)
    rows = np.where(inside, rows, 0).view(np.uint64)
    return rows, short


def _room(x: np.ndarray, n: int) -> np.ndarray:
    """The array with room for ``n`` entries, at least half as many again if it grows."""
    if n <= len(x):
        return x
    out = np.zeros((max(n, len(x) * 3 // 2), *x.shape[1:]), x.dtype)
    out[:len(x)] = x
    return out


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + size), one after another."""
    total = int(sizes.sum())
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker process."""
    return Encoder(path)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
