"""Licence scan with a positional index of licence notices.

The index holds every word of the notices with its positions (postings). A
notice can only stand in a file that holds its mandatory key phrases, and so
the rarest word of these (the highest inverse document frequency over all
documents). A file is therefore looked up by its licence words that are the
rarest of some notice: each such place gives the position at which the notice
would begin (a word that the phrases hold twice counts at its first place in
them). The notice's other postings are intersected with the file's
words by relative position, a few words of drift allowed; the matched share
of the notice's weight (its words' inverse frequencies) must reach
``MIN_SHARE``, and every key phrase must stand there word for word.

Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased.
The index is fixed text of a few hundred words, and so are the frequencies
that are collected for it.

Rows: a null or empty text has no words and no places; repeated rows are
scanned each; a document is scanned in one task; other columns are ignored or
carried; without documents there is no result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerline.llm import common
from offerline.llm.decontaminate import WORD, words_of

DRIFT = 2           # words by which a posting may be off its relative position
MIN_SHARE = 0.6
PLACE = "array<struct<label:string,base:boolean,word:int,n_words:int,share:double,start:int,end:int>>"

# Phrases that always count.
BASE_PHRASES = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))

# Label, notice text, mandatory key phrases.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
            "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
            "merge publish distribute sublicense and or sell copies of the software",
     ("hereby granted free of charge", "to deal in the software without restriction")),
    ("mit", "licensed under the terms of the mit license", ("terms of the mit license",)),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
     ("apache license version 2", "except in compliance with the license")),
    ("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-2", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license",
     ("gnu general public license", "version 2 of the license")),
    ("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-3", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license",
     ("gnu general public license", "version 3 of the license")),
    ("lgpl-2", "under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license",
     ("gnu lesser general public license", "version 2 1 of the license")),
    ("lgpl-3", "under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license",
     ("gnu lesser general public license", "version 3 of the license")),
    ("agpl-3", "under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license",
     ("gnu affero general public license", "version 3 of the license")),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
     ("eclipse public license 2 0",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
            "conditions are met", ("redistribution and use in source and binary forms",)),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
              "from this software without specific prior written permission", ("endorse or promote products derived from this software",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
            "that the above copyright notice and this permission notice appear in all copies",
     ("distribute this software for any purpose with or without fee is hereby granted",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any "
             "damages arising from the use of this software", ("authors be held liable for any damages arising from the use of this software",)),
    ("bsl-1", "distributed under the boost software license version 1 0", ("boost software license version 1 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
     ("waived all copyright and related or neighboring rights",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc-by", "licensed under cc by 4 0", ("under cc by 4 0",)),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
     ("creative commons attribution sharealike 4 0",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("under cc by sa 4 0",)),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
     ("creative commons attribution noncommercial 4 0",)),
)


@dataclass(frozen=True)
class Notice:
    label: str
    base: bool
    words: tuple[bytes, ...]
    phrases: tuple[tuple[int, tuple[bytes, ...]], ...]      # place in the words, words


def notice(label: str, text: str, phrases, base: bool = False) -> Notice:
    words, found = tuple(words_of(text)), []
    for phrase in phrases:
        part = tuple(words_of(phrase))
        at = [i for i in range(len(words) - len(part) + 1) if words[i:i + len(part)] == part]
        if not part or not at:
            raise ValueError(f"{label}: the notice does not hold its phrase {phrase!r}")
        found.append((at[0], part))
    return Notice(label, base, words, tuple(found))


def notices() -> list[Notice]:
    return [notice(label, p, (p,), True) for label, p in BASE_PHRASES] + [notice(*n) for n in NOTICES]


def document_counts(docs: DataFrame, known: list[Notice], text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """(documents, documents that hold each word of the notices); one row a
    word of the notices reaches the driver."""
    words = frozenset(w for n in known for w in n.words)

    def run(batches):
        n, held = 0, Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                held.update(words.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array([None, *(w.decode() for w in held)], pa.string()), pa.array([n, *held.values()], pa.int64())], ["word", "n"])

    rows = docs.select(common.text_of(text_col).alias("t")).mapInArrow(common.trimming(run), "word string, n long")
    sums = {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return sums.pop(None, 0), {w.encode(): n for w, n in sums.items()}


class Index:
    """Postings of the notices by word, and each notice's rarest mandatory word."""

    def __init__(self, known: list[Notice], n_docs: int, held: dict[bytes, int], drift: int = DRIFT, min_share: float = MIN_SHARE):
        self.notices, self.drift, self.min_share = known, drift, min_share
        self.weight = {w: math.log((n_docs + 1) / (held.get(w, 0) + 1)) + 1.0 for n in known for w in n.words}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.lookup: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, n in enumerate(known):
            for q, w in enumerate(n.words):
                self.postings[w].append((t, q))
            rarest = max((w for _, part in n.phrases for w in part), key=lambda w: (self.weight[w], w))
            q = next(at + i for at, part in n.phrases for i, w in enumerate(part) if w == rarest)
            self.lookup[rarest].append((t, q))
        self.whole = [sum(self.weight[w] for w in n.words) for n in known]
        self.rare = frozenset(self.lookup)

    def places(self, words: list[bytes]) -> list[tuple[int, int, int, float]]:
        """(notice, first word, number of words, share) of every verified place."""
        at = defaultdict(list)
        for p, w in enumerate(words):
            if w in self.postings:
                at[w].append(p)
        near = {p: w for w, found in at.items() for p in found}
        out = []
        for w in sorted(at.keys() & self.rare, key=lambda w: (-self.weight[w], w)):
            for p in at[w]:
                for t, q in self.lookup[w]:
                    found = self.fits(t, p - q, words, near)
                    if found:
                        out.append((t, *found))
        return sorted(set(out), key=lambda x: (x[1], x[0], x[2]))

    def fits(self, t: int, begin: int, words: list[bytes], near: dict[int, bytes]) -> tuple[int, int, float] | None:
        n, held, first, last = self.notices[t], 0.0, None, None
        drift = 0 if n.base else self.drift
        shifts = sorted(range(-drift, drift + 1), key=abs)
        for q, w in enumerate(n.words):
            p = next((begin + q + d for d in shifts if near.get(begin + q + d) == w), None)
            if p is not None:
                held += self.weight[w]
                first, last = (p if first is None else min(first, p)), (p if last is None else max(last, p))
        share = min(1.0, held / self.whole[t])
        if share < self.min_share:
            return None
        for q, part in n.phrases:
            if not any(begin + q + d >= 0 and tuple(words[begin + q + d:begin + q + d + len(part)]) == part for d in shifts):
                return None
        return first, last - first + 1, share


def scan(docs: DataFrame, known: list[Notice] | None = None, carry=(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, carried columns, n_words, places): every place of a notice or base
    phrase with its label, first word, number of words, matched share and
    character offsets in the text."""
    known = notices() if known is None else known
    n_docs, held = document_counts(docs, known, text_col)
    index = docs.sparkSession.sparkContext.broadcast(Index(known, n_docs, held))    # fixed text, some kilobytes
    kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("word", pa.int32()), ("n_words", pa.int32()),
                               ("share", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batch: pa.RecordBatch):
        own, counts, found = index.value, [], []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            words = words_of(text)
            counts.append(len(words))
            places = [] if own.rare.isdisjoint(words) else own.places(words)
            spans = [m.span() for m in WORD.finditer(text)] if places else []
            found.append([{"label": own.notices[t].label, "base": own.notices[t].base, "word": p, "n_words": n, "share": share,
                           "start": spans[p][0], "end": spans[p + n - 1][1]} for t, p, n, share in places])
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(found, kind)], names)

    rows = docs.select(F.col(id_col).alias("id"), *carry, common.text_of(text_col).alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    names = [f.name for f in rows.schema.fields[:-1]] + ["n_words", "places"]
    return common.map_batches(rows, run, ", ".join([*fields, "n_words long", f"places {PLACE}"]))
