"""The licence scan against brute force: every notice at every position."""

import math
import random
import re
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001/documents.parquet"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER))


def plain(rows):
    """Each notice is tried at each position of each text, without an index;
    positions are relative to the rarest word of its phrases."""
    from offerline.llm import license_scan as s

    all_words = [words_of(r["text"]) for r in rows]
    notices = [(label, phrase.split(), [(0, phrase.split())], 0) for label, phrase in BASE.items()]
    for label, text, phrases in s.NOTICES:
        words = text.split()
        at = [next(i for i in range(len(words)) if words[i:i + len(p.split())] == p.split()) for p in phrases]
        notices.append((label, words, list(zip(at, [p.split() for p in phrases])), s.DRIFT))
    vocabulary = {w for n in notices for w in n[1]}
    held = {w: 0 for w in vocabulary}
    for words in all_words:
        for w in set(words) & vocabulary:
            held[w] += 1
    weight = {w: math.log((len(rows) + 1) / (n + 1)) + 1 for w, n in held.items()}
    out = []
    for r, words in zip(rows, all_words):
        base, labels, best = [], set(), 0.0
        if vocabulary & set(words):
            for k, (label, notice, phrases, drift) in enumerate(notices):
                rare = max({w for _, part in phrases for w in part}, key=lambda w: (weight[w], w))
                pin = next(q + part.index(rare) for q, part in phrases if rare in part)
                for begin in range(-len(notice), len(words)):
                    near = lambda q: range(max(0, begin + q - drift), max(0, begin + q + drift + 1))  # noqa: E731, B023
                    if not (0 <= begin + pin < len(words) and words[begin + pin] == rare):
                        continue
                    if not all(any(words[p:p + len(part)] == part for p in near(q)) for q, part in phrases):
                        continue
                    share = sum(weight[w] for q, w in enumerate(notice) if w in [words[p] for p in near(q) if p < len(words)]) / sum(weight[w] for w in notice)
                    if share >= s.MIN_SHARE:
                        labels.add(label)
                        best = max(best, share)
                        if k < len(BASE):
                            base.append((begin, label))
        out.append((r["doc_id"], len(words), len(base), min(base)[0] if base else None, max(base)[0] if base else None,
                    ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), round(best, 9)))
    return out


def key(rows):
    return sorted(tuple(str(x) for x in r) for r in rows)


@pytest.fixture(scope="module")
def rows():
    from offerline.llm import license_scan as s

    rnd = random.Random(2)
    docs = pq.read_table(SF).to_pylist()
    texts = [None, "", " \n", "Under the MIT license under the MIT License!", "under the\nMIT\tlicense cc-by-nc 4.0 CC BY NC apache License, version 2",
             "cc by", "apache license version", "under the mit licens é", "écc by nc", "cc by ncé"]
    for label, text, _ in s.NOTICES:
        words = text.split()
        texts += ["Intro text. " + text.upper() + ". " + docs[1]["text"], "# " + " \n# ".join(words), " ".join(words[:len(words) // 2])]
        for _ in range(4):      # some words lost or added
            k, own = rnd.randrange(len(words)), list(words)
            own[k:k + 1] = rnd.choice([[], [own[k], "new"], ["other"]])
            texts.append(" ".join(own))
    texts += [" ".join(docs[2]["text"].split() * 400) + " released under the mit license", " ".join(n[1] for n in s.NOTICES), texts[3], texts[3]]
    docs += [{"doc_id": 10_000 + i, "text": t, "lang": None, "source": None, "n_chars": 0} for i, t in enumerate(texts)]
    docs.append({"doc_id": None, "text": "cc by nc", "lang": None, "source": None, "n_chars": None})
    return docs


def test_op12_equals_brute_force(spark, rows):
    from offerline.llm import queries

    folder = tempfile.mkdtemp(prefix="offerline-licence-")
    pq.write_table(pa.Table.from_pylist([r | {"id": "clash", "places": 1, "n_words": None} for r in rows]), f"{folder}/documents.parquet")
    got = queries.QUERIES["op12_license_scan"](spark, folder)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    found = [(*r[:-1], round(r["score"], 9)) for r in got.collect()]
    assert key(found) == key(plain(rows))
    assert {x for r in found for x in r[6].split(",")} > {"mit", "apache-2", "cc-by-nc", "gpl-3", "bsd-3", "isc", "mpl-2"}


def test_op12_offsets_reach_the_text(spark, rows):
    from offerline.llm import license_scan

    docs = spark.createDataFrame([(1, "Ünder: RELEASED  under the\nMIT license.", "x")], "doc_id long, text string, id string")
    (place,) = license_scan.scan(docs, carry=("text",)).first()["places"]
    assert "Ünder: RELEASED  under the\nMIT license."[place["start"]:place["end"]] == "under the\nMIT license"
    assert (place["label"], place["base"], place["word"], place["n_words"], place["share"]) == ("mit", True, 2, 4, 1.0)


def test_op12_without_documents(spark):
    from offerline.llm import queries

    folder = tempfile.mkdtemp(prefix="offerline-licence-")
    pq.write_table(pa.Table.from_pylist([], schema=SCHEMA), f"{folder}/documents.parquet")
    assert queries.QUERIES["op12_license_scan"](spark, folder).collect() == []


def test_op12_notice_needs_its_phrase():
    from offerline.llm import license_scan

    with pytest.raises(ValueError):
        license_scan.notice("x", "some words here", ("other words",))
