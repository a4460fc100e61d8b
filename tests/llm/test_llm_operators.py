"""The operators' queries against brute force, on a small fixture: driver
documents and rows with nulls, empty and long texts, copies, repeated rows
and extra columns with clashing names."""

import collections
import hashlib
import os
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def write(rows, folder, name, schema=None):
    pq.write_table(pa.Table.from_pylist(rows, schema=schema), f"{folder}/{name}.parquet")


@pytest.fixture(scope="module")
def sf(spark):
    folder = tempfile.mkdtemp(prefix="offerline-llm-fixture-")
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    last = max(r["doc_id"] for r in docs)
    long = " ".join(r["text"] for r in docs[:40])
    bench = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    odd = [None, "", "  \n\t ", "short", "<|endoftext|> a<|endoftext|>", "!!!", "12 34", long, long + " x", docs[3]["text"], docs[3]["text"],
           docs[5]["text"].upper(), "é" * 60 + "x", "ü" * 60 + "y", "zé" * 60, "b" * 400, "b" * 300, "so: " + bench[0]["text"] + " end"]
    docs += [{"doc_id": last + 1 + i, "text": t, "lang": "en" if i % 2 else None, "source": None, "n_chars": 0} for i, t in enumerate(odd)]
    docs += [dict(docs[0]), dict(docs[0])]
    for r in docs:
        r |= {"id": 1, "fp": "x", "score": None, "t": "clash", "part": 3, "rid": "r"}
    write(docs, folder, "documents")
    labels = pq.read_table(f"{SF}/labels.parquet").to_pylist()
    write(labels + [{"doc_id": last + 1, "quality": None, "toxic": None}, {"doc_id": None, "quality": 0, "toxic": None}], folder, "labels")
    write(bench + [{"item_id": 9000, "text": None}, {"item_id": 9001, "text": "..."}, {"item_id": 9002, "text": "Short"}, bench[0] | {"item_id": 9003}], folder, "benchmark")
    convs = pq.read_table(f"{SF}/conversations.parquet").to_pylist()
    convs += [{"conv_id": 10**6, "turn": 0, "role": None, "text": None}, {"conv_id": 10**6, "turn": 1, "role": "assistant", "text": "x\\<|im_end|>\\n<|"},
              {"conv_id": None, "turn": 0, "role": "us\ner", "text": "a<"}, dict(convs[0]), dict(convs[1])]
    write(convs, folder, "conversations")
    return folder


@pytest.fixture(scope="module")
def docs(sf):
    return pq.read_table(f"{sf}/documents.parquet").to_pylist()


def run(spark, name, folder):
    from offerline.llm.queries import QUERIES

    return QUERIES[name](spark, folder).toPandas().to_dict("records")


def key(rows, *columns):
    return sorted(tuple(str(r[c]) for c in columns) for r in rows)


def words(text):
    return (text or "").encode().lower().split()


def test_op2_equals_brute_force(spark, sf, docs, monkeypatch):
    first = {}
    for r in docs:
        data = (r["text"] or "").encode()
        for p in range(len(data) - 49):
            s = data[p:p + 50]
            first[s] = min(first.get(s, r["doc_id"]), r["doc_id"])
    want = []
    for r in docs:
        data = (r["text"] or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - 49):
            if first[data[p:p + 50]] < r["doc_id"]:
                gone[p:p + 50] = True
        edge = np.diff(np.concatenate([[0], gone]).astype(int))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        want.append({"doc_id": r["doc_id"], "n_bytes": len(data), "n_removed": len(data) - len(kept), "n_spans": int((edge == 1).sum()),
                     "kept_sha256": hashlib.sha256(kept).hexdigest()})
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert key(run(spark, "op2_suffix_dedup", sf), *columns) == key(want, *columns)
    from offerline.llm import suffix_dedup

    # Windows of frequent anchors dealt one by one, many small batches and buckets.
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 40_000)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for hot in (0, 5):
            got = suffix_dedup.dedup(spark.read.parquet(f"{sf}/documents.parquet"), hot_runs=hot).withColumnRenamed("id", "doc_id")
            assert key([r.asDict() for r in got.collect()], *columns) == key(want, *columns)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_op2_merge_equals_brute_force():
    import random

    from offerline.llm import suffix_dedup as s

    rnd = random.Random(3)
    for _ in range(20):
        base = bytes(rnd.choice(b"ab") for _ in range(300))
        texts = []
        for _ in range(rnd.randint(1, 30)):
            a = rnd.randint(0, 200)
            t = base[a:a + rnd.randint(50, 90)]
            texts.append(t[:20] + b"c" + t[21:] if rnd.random() < 0.5 else t)
        ids = np.array([rnd.randint(0, 9) for _ in texts], np.int64)
        low = {}
        for t, i in zip(texts, ids):
            for p in range(len(t) - 49):
                low[t[p:p + 50]] = min(low.get(t[p:p + 50], i), i)
        shard, s.SHARD_STRINGS = s.SHARD_STRINGS, 7
        got = s.repeated(texts, ids, 50)
        s.SHARD_STRINGS = shard
        assert all(g.tolist() == [low[t[p:p + 50]] for p in range(len(t) - 49)] for g, t in zip(got, texts))


def test_op3_equals_brute_force(spark, sf):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = pq.read_table(f"{sf}/conversations.parquet").to_pylist() + [
        {"conv_id": -1, "turn": 0, "role": "user", "text": said}, {"conv_id": -1, "turn": 1, "role": "assistant", "text": said}]
    convs = collections.defaultdict(list)
    for r in rows:
        convs[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    got = {None if r["conv_id"] != r["conv_id"] else r["conv_id"]: r for r in run(spark, "op3_chat_prefix_tree", sf)}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_op3_tree_shares_and_attends(spark, sf):
    import public_tokenizers
    from offerline.llm import chat_tree, common

    common.ship_package(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (2, 0, "user", "hi"), (2, 1, "assistant", "b"),
                                  (3, 0, "user", "hi"), (4, 0, "user", "yo")], "conv_id long, turn long, role string, text string")
    convs = chat_tree.conversations(rows)
    tree = sorted(chat_tree.nodes(convs, path).collect(), key=lambda r: r.stream_start)
    assert len(tree) == 4
    at = 0
    for n in tree:
        assert (n.stream_start, n.n_tokens) == (at, len(n.ids))
        assert len(n.ancestors) == n.depth and n.position_start == sum(a.length for a in n.ancestors)
        at += n.n_tokens
    assert all(n.depth == 0 or n.ancestors[0].start in [m.stream_start for m in tree if m.depth == 0] for n in tree)
    assert [n.depth for n in tree] in ([0, 1, 1, 0], [0, 0, 1, 1])


@pytest.fixture(scope="module")
def encoders():
    import public_tokenizers
    from tokenizers import Tokenizer

    out = {}
    for n in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        out[n] = Tokenizer.from_file(public_tokenizers.path(n))
        out[n].encode_special_tokens = True
    return out


def test_op4_pieces_and_sequences(spark, sf, docs, encoders):
    got = run(spark, "op4_packing", sf)
    want = []
    for r in docs:
        ids = encoders["byte_bpe_50k.json"].encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for a in range(0, len(ids), 1024):
            part = ids[a:a + 1024]
            want.append({"doc_id": r["doc_id"], "start": a, "length": len(part), "doc_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(part, "<u4").tobytes())})
    columns = ("doc_id", "start", "length", "doc_tokens", "ids_crc32")
    assert key(got, *columns) == key(want, *columns)
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    padded = total = 0
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
        total += at
        padded += 0 if at & (at - 1) == 0 else 1024 - at
    assert padded < 0.05 * total


def test_op4_windows_against_all_subsets():
    import itertools

    from offerline.llm.packing import best_window, padding

    rng = np.random.default_rng(5)
    for _ in range(50):
        lengths = rng.integers(1, 60, 9)
        counts = np.bincount(lengths, minlength=65)
        used = best_window(counts, 64)
        fill = sum(x * n for x, n in used.items())
        longest = max(lengths)
        rest = sorted(lengths)[:-1]
        best = min(padding(longest + sum(c), 64) for k in range(9) for c in itertools.combinations(rest, k) if longest + sum(c) <= 64)
        assert fill <= 64 and padding(fill, 64) == best and all(counts[x] >= n for x, n in used.items())


def test_op5_separates_quality(spark, docs):
    # The driver's small tables hold too few labels; sf0.01 has some.
    got = {r["doc_id"]: r for r in run(spark, "op5_quality_knn", "/root/testdata/sf0.01")}
    labels = pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist()
    held = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels if got[r["doc_id"]]["held_out"]]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    assert sum(p == q for p, q in held) >= 0.9 * len(held)


def test_op5_odd_rows(spark, sf, docs):
    assert len(run(spark, "op5_quality_knn", sf)) == len(docs)


def test_op6_counts_equal_brute_force(spark, sf, docs):
    import re

    want = []
    for r in docs:
        text = r["text"] or ""
        own = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(own[i:i + 5]) for i in range(len(own) - 4)]
        n = collections.Counter(windows)
        again = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
        want.append({"doc_id": r["doc_id"], "n_words": len(own), "word_chars": sum(map(len, own)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
                     "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again),
                     "base_failed": len(own) < 10 or 100 * len(again) > 20 * len(own)})
    got = run(spark, "op6_quality_rules", sf)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert key(got, *columns) == key(want, *columns)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_op6_learns_a_list():
    from offerline.llm import rules

    rows = [((float(i % 7), 0.0, 0.0, 0.0, u := (i * 37 % 100) / 100, 0.0, 1.0), u > 0.6, i % 3 == 0) for i in range(600)]
    learned = rules.learn(rows)
    assert learned and sum(any(rules.holds(x, v) for x in learned) == drop for v, drop, _ in rows) >= 0.97 * len(rows)
    assert rules.learn([]) == []


def test_op7_languages(spark, sf, docs):
    got = run(spark, "op7_language_ppm", sf)
    lang = {r["doc_id"]: (r["lang"], r["text"]) for r in docs}
    known = [r for r in got if r["held_out"] and lang[r["doc_id"]][0] and len(lang[r["doc_id"]][1] or "") > 40]
    assert sum(r["lang_pred"] == lang[r["doc_id"]][0] for r in known) >= 0.95 * len(known)
    for r in got:
        text = lang[r["doc_id"]][1] or ""
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text))
        assert 0 <= r["score"] <= 1


def test_op7_code_lengths_equal_a_plain_ppm():
    import math

    from offerline.llm import langid

    train = [b"the cat sat on the mat", b"that hat"]
    code, n = np.unique(np.concatenate([langid.grams(np.frombuffer(langid.START + t, np.uint8)) for t in train]), return_counts=True)
    coder = langid.Coder({"xx": (code, n.astype(float))})
    counts = collections.defaultdict(collections.Counter)
    for t in train:
        t = langid.START + t
        for i in range(langid.ORDER, len(t)):
            for k in range(langid.ORDER + 1):
                counts[t[i - k:i]][t[i]] += 1
    for text in (b"the rat", b"zebra\xff", b"", b"th"):
        data, bits = langid.START + text, 0.0
        for i in range(langid.ORDER, len(data)):
            gone = set()
            for k in range(langid.ORDER, -1, -1):
                own = {c: m for c, m in counts.get(data[i - k:i], {}).items() if c not in gone}
                if not own:
                    continue
                total = sum(own.values()) + len(own)
                if data[i] in own:
                    bits -= math.log2(own[data[i]] / total)
                    break
                bits -= math.log2(len(own) / total)
                gone |= set(own)
            else:
                bits += math.log2(256 - len(gone))
        assert abs(coder.lengths([text])[0, 0] - bits) < 1e-3 * (1 + bits)


@pytest.mark.parametrize("limit", [None, 2000])
def test_op8_equals_brute_force(spark, sf, docs, limit):
    from offerline.llm import common, decontaminate as d

    windows = collections.defaultdict(set)
    for r in pq.read_table(f"{sf}/benchmark.parquet").to_pylist():
        own = d.words_of(r["text"] or "")
        for i in range(max(1, len(own) - 9) if own else 0):
            windows[tuple(own[i:i + 10])].add(str(r["item_id"]))
    sizes = {len(w) for w in windows}
    want = []
    for r in docs:
        own, hit, items = d.words_of(r["text"] or ""), set(), set()
        for n in sizes:
            for i in range(len(own) - n + 1):
                if found := windows.get(tuple(own[i:i + n])):
                    hit |= set(range(i, i + n))
                    items |= found
        want.append({"doc_id": r["doc_id"], "n_words": len(own), "n_hit": len(hit), "n_items": len(items), "contaminated": bool(hit),
                     "items_sha256": hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()})
    if limit is None:
        columns = ("doc_id", "n_words", "n_hit", "n_items", "contaminated", "items_sha256")
        assert key(run(spark, "op8_decontaminate", sf), *columns) == key(want, *columns)
    else:   # several automata, pass by pass
        common.ship_package(spark)
        rows = d.decontaminate(common.table(spark, sf, "documents"), common.table(spark, sf, "benchmark"), max_pattern_bytes=60_000).collect()
        assert sorted((r.id, r.n_words, len(r.hits)) for r in rows) == sorted((w["doc_id"], w["n_words"], w["n_hit"]) for w in want)


def test_op9_equals_brute_force(spark, sf, docs):
    prints = []
    for r in docs:
        own = words(r["text"])
        parts = [b" ".join(own[i:i + 3]) for i in range(max(1, len(own) - 2))] if own else []
        h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        prints.append(sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(docs):
        low[find(i)] = min(low.get(find(i), r["doc_id"]), r["doc_id"])
    want = [{"doc_id": r["doc_id"], "fingerprint": f"{prints[i]:016x}", "component_id": low[find(i)]} for i, r in enumerate(docs)]
    columns = ("doc_id", "fingerprint", "component_id")
    assert key(run(spark, "op9_simhash", sf), *columns) == key(want, *columns)


def test_op9_links_lose_none(spark):
    from offerline.llm import common, simhash

    common.ship_package(spark)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 40)
    fps = set(base.tolist())
    for b in base[:20].tolist():
        for _ in range(6):
            for bit in rng.integers(0, 63, rng.integers(1, 4)):
                b ^= 1 << int(bit)
            fps.add(b)
    fps = sorted(fps)
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= 2}
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    assert {(r.a, r.b) for r in simhash.links(frame).collect()} == want
    want3 = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= 3}
    assert {(r.a, r.b) for r in simhash.links(frame, 3).collect()} == want3


def test_op10_equals_the_library(spark, sf, docs, encoders):
    start, want = 0, []
    for r in sorted(docs, key=lambda r: (r["doc_id"], r["text"] or "")):
        ids = encoders["word_bpe_49k.json"].encode(r["text"] or "", add_special_tokens=False).ids + [1]
        want.append({"doc_id": r["doc_id"], "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(ids, "<u4").tobytes())})
        start += len(ids)
    columns = ("doc_id", "start", "n_tokens", "ids_crc32")
    assert key(run(spark, "op10_token_store", sf), *columns) == key(want, *columns)


@pytest.mark.parametrize("name", ["op1_ngram_lm", "op2_suffix_dedup", "op4_packing", "op5_quality_knn", "op6_quality_rules", "op7_language_ppm",
                                  "op8_decontaminate", "op9_simhash", "op10_token_store"])
def test_empty_tables(spark, sf, name):
    folder = tempfile.mkdtemp(prefix="offerline-llm-empty-")
    for t in ("documents", "labels", "benchmark"):
        write([], folder, t, schema=pq.read_schema(f"{SF}/{t}.parquet"))
    assert run(spark, name, folder) == []

def test_op1_elias_fano():
    from offerline.llm.ngram_lm import EliasFano

    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (5, 3), (1000, 10**9), (1000, 1500), (300, 2**55)):
        values = np.sort(rng.integers(0, top, n)).astype(np.uint64)
        code = EliasFano.code(values, top)
        seq = EliasFano(code["low"], code["high"], code["width"], code["size"])
        assert seq.values().tolist() == values.tolist()
        asked = np.concatenate([values, rng.integers(0, top, 200).astype(np.uint64)])
        at = seq.find(asked)
        assert all((a >= 0 and values[a] == x) if x in set(values.tolist()) else a == -1 for a, x in zip(at.tolist(), asked.tolist()))


def removed_bytes(rows):
    """Per row: which bytes a 50-byte string of a smaller doc_id covers."""
    first = {}
    for r in rows:
        data = (r["text"] or "").encode()
        for p in range(len(data) - 49):
            first[data[p:p + 50]] = min(first.get(data[p:p + 50], r["doc_id"]), r["doc_id"])
    for r in rows:
        data = (r["text"] or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 49):
            if first[data[p:p + 50]] < r["doc_id"]:
                gone[p:p + 50] = True
        yield r, data, gone


def one_a_group(rows):
    """The row of the smallest doc_id of each group of fingerprints."""
    prints = []
    for r in rows:
        own = words(r["text"])
        h = [xxhash.xxh64_intdigest(b" ".join(own[i:i + 3]), 42) for i in range(max(1, len(own) - 2))] if own else []
        prints.append(sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and (prints[i] ^ prints[j]).bit_count() <= 2:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    low = {}
    for g, r in zip(group, rows):
        if g not in low or r["doc_id"] < low[g]["doc_id"]:
            low[g] = r
    return list(low.values())


def test_pipeline_equals_brute_force(spark, sf, docs, encoders):
    import corpus_pipeline
    from offerline.llm import decontaminate, quality_knn

    labels = {}
    for r in pq.read_table(f"{sf}/labels.parquet").to_pylist():
        if r["doc_id"] is not None and r["quality"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            labels[r["doc_id"]] = min(labels.get(r["doc_id"], 1), r["quality"])
    text = {r["doc_id"]: r["text"] or "" for r in docs}
    known = sorted(i for i in labels if i in text)
    rows = docs
    if known:
        weights = quality_knn.term_weights([text[i] for i in known]).astype(np.float16).astype(np.float32)
        space = quality_knn.Space(weights, np.array([labels[i] for i in known], np.int32))
        rows = [r for r in docs if space.score([r["text"] or ""])[0] >= 0.7]
    else:
        rows = []
    rows = one_a_group(rows)
    cut = []
    for r, data, gone in list(removed_bytes(rows)):
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(int))).tolist()
        kept = "".join(data[a:b].decode("utf-8", "ignore") for a, b in zip(edge[::2], edge[1::2]))
        if not gone.any() or kept:
            cut.append((r["doc_id"], kept))
    windows = set()
    for r in pq.read_table(f"{sf}/benchmark.parquet").to_pylist():
        own = decontaminate.words_of(r["text"] or "")
        windows |= {tuple(own[i:i + 10]) for i in range(max(1, len(own) - 9) if own else 0)}
    sizes = {len(w) for w in windows}
    want = []
    for i, t in cut:
        own = decontaminate.words_of(t)
        if any(tuple(own[k:k + n]) in windows for n in sizes for k in range(len(own) - n + 1)):
            continue
        ids = encoders["byte_bpe_50k.json"].encode(t, add_special_tokens=False).ids + [0]
        for a in range(0, len(ids), 1024):
            part = ids[a:a + 1024]
            want.append({"doc_id": i, "start": a, "length": len(part), "doc_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(part, "<u4").tobytes())})
    got = corpus_pipeline.run(spark, sf).toPandas().to_dict("records")
    columns = ("doc_id", "start", "length", "doc_tokens", "ids_crc32")
    assert key(got, *columns) == key(want, *columns)


def test_pipeline_near_duplicates_without_ids(spark, sf):
    import corpus_pipeline

    long = [" ".join(f"{c}{i}" for i in range(30)) for c in "abc"]
    rows = spark.createDataFrame([(4, long[0]), (None, long[0]), (None, long[1]), (None, long[1]), (9, long[2]), (2, long[2]), (7, None)],
                                 "doc_id long, text string").selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    got = stage(spark, rows, sf)
    assert tuple(got.columns) == corpus_pipeline.COLUMNS
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, [(4, long[0]), (None, long[1]), (2, long[2]), (7, None)]))


def test_op4_sequences_hold_the_ids(spark, sf, encoders):
    import corpus_pipeline
    from offerline.llm import common, packing
    import public_tokenizers

    common.ship_package(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    fixture = common.table(spark, sf, "documents")
    encode = lambda t: encoders["byte_bpe_50k.json"].encode(t or "", add_special_tokens=False).ids + [0]
    ids = collections.Counter((r.doc_id, tuple(encode(r.text))) for r in fixture.select("doc_id", "text").collect())
    seqs = {r.sequence_id: r for r in packing.sequences(packing.pack(fixture, path), pad_id=7).collect()}
    stage = dict(corpus_pipeline.STAGES)["packing"](spark, fixture, sf)
    for got, pad in ((list(seqs.values()), 7), ([r for r in stage.collect() if r.offset == 0], 0)):
        fills = []
        for r in got:
            data = np.frombuffer(r.ids, "<u4").tolist() if pad else list(r.sequence)
            if pad:
                n = r.n_tokens
                assert data[n:] == [pad] * (len(data) - n)
                fills.append(n)
            assert len(data) == 1024 or len(data) & (len(data) - 1) == 0
    # Documents put together again from the sequences alone.
    whole = collections.defaultdict(list)
    for r in seqs.values():
        data = np.frombuffer(r.ids, "<u4").tolist()
        for p, stop in zip(r.pieces, [q.offset for q in r.pieces[1:]] + [r.n_tokens]):
            whole[p.doc_id].append((p.start, data[p.offset:stop]))
    want = collections.defaultdict(list)
    for (i, t), n in ids.items():
        want[i] += [(a, list(t[a:a + 1024])) for a in range(0, len(t), 1024)] * n
    assert {i: sorted(x) for i, x in whole.items()} == {i: sorted(x) for i, x in want.items()}
    rows = stage.collect()
    held = {r.sequence_id: r.sequence for r in rows if r.sequence is not None}
    assert set(held) == {r.sequence_id for r in rows}
    assert all(zlib.crc32(np.array(held[r.sequence_id][r.offset:r.offset + r.length], "<u4").tobytes()) == r.ids_crc32 for r in rows)


@pytest.mark.parametrize("fill, size", [(1, 1), (2, 2), (3, 8), (4, 4), (5, 8), (7, 8), (8, 8)])
def test_op4_power_of_two_is_not_padded(spark, fill, size):
    from offerline.llm import packing

    parts = [(1, 0, n, 9, np.arange(1, n + 1, dtype="<u4").tobytes(), 3, at) for n, at in ([(fill, 0)] if fill in (1, 8) else [(1, 0), (fill - 1, 1)])]
    packed = spark.createDataFrame(parts[::-1], packing.PIECE + ", sequence_id long, offset long")
    got, = packing.sequences(packed, window=8, pad_id=7).collect()
    ids = [x for n, *_ in [(p[2],) for p in parts] for x in range(1, n + 1)]
    assert (got.n_tokens, np.frombuffer(got.ids, "<u4").tolist()) == (fill, ids + [7] * (size - fill))


def test_op1_equals_brute_force(spark, sf, docs, monkeypatch):
    import math

    from offerline.llm import ngram_lm

    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 40_000)     # several shards and split context words
    texts = [words(r["text"]) + ["end"] for r in docs]
    n = [collections.Counter() for _ in range(4)]
    for r, t in zip(docs, texts):
        if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            p = ["s", "s", *t]
            for k in (1, 2, 3):
                n[k].update(tuple(p[i - k + 1:i + 1]) for i in range(2, len(p)))
    d = [0.0] + [(ones := sum(x == 1 for x in c.values())) / (ones + 2 * sum(x == 2 for x in c.values())) for c in n[1:]]
    assert 0 < d[2] < 1 and 0 < d[3] < 1
    total, types = sum(n[1].values()), len(n[1])
    ctx, succ = collections.Counter(), collections.Counter()
    for k in (2, 3):
        for g, x in n[k].items():
            ctx[g[:-1]] += x
            succ[g[:-1]] += 1

    def q(x):
        return 10 ** (-math.ceil(-math.log10(x) * 32 - 1e-9) / 32) if x > 0 else 0.0

    want, once = {}, 0
    for r, t in zip(docs, texts):
        p, score, base = ["s", "s", *t], 0.0, 0.0
        for i in range(2, len(p)):
            base += math.log10((n[1][p[i],] + 1) / (total + types + 1))
            at = (n[1][p[i],] - d[1] if n[1][p[i],] else d[1] * types) / total
            for k in (2, 3):
                g = tuple(p[i - k + 1:i + 1])
                if c := ctx[g[:-1]]:
                    at = q((n[k][g] - d[k]) / c if n[k][g] else 0) + q(d[k] * succ[g[:-1]] / c) * at
                once += n[k][g] == 1
            score += math.log10(at)
        want.setdefault(r["doc_id"], []).append((len(t), sum(n[1][w,] > 0 for w in t), base, score))
    assert once
    got = run(spark, "op1_ngram_lm", sf)
    assert len(got) == len(docs) and {r["train_tokens"] for r in got} == {total}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert any((r["n_tokens"], r["n_known"]) == w[:2] and abs(r["base_score"] - w[2]) < 1e-6 * (1 - w[2]) and abs(r["score"] - w[3]) < 1e-6 * (1 - w[3])
                   for w in want[r["doc_id"]]), (list(r.values()), want[r["doc_id"]])


def test_op3_reads_through_the_intervals(spark, sf, encoders):
    import public_tokenizers
    from offerline.llm import chat_tree, common

    rows = pq.read_table(f"{sf}/conversations.parquet").to_pylist()
    convs = collections.defaultdict(list)
    for r in rows:
        convs[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    size = lambda r, t: sum(len(encoders["byte_bpe_50k.json"].encode(x, add_special_tokens=False).ids) for x in chat_tree.format_turn(r, t))
    got = {None if r["conv_id"] != r["conv_id"] else r["conv_id"]: r for r in run(spark, "op3_chat_prefix_tree", sf)}
    for c, turns in convs.items():
        turns.sort()
        assert got[c]["n_ancestors"] == len(turns) - 1
        assert got[c]["position_start"] == sum(size(r, t) for _, r, t in turns[:-1])
    # Wrong intervals show in the digests.
    common.ship_package(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    few = chat_tree.conversations(spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (2, 0, "user", "yo"), (2, 1, "assistant", "b")],
                                                        "conv_id long, turn long, role string, text string"))
    tree = chat_tree.nodes(few, path)
    starts = {r.ancestors[0].start for r in tree.collect() if r.depth}
    wrong = tree.selectExpr("key", "rank", "depth", "n_tokens", "ids", "loss_start", "loss_length", "stream_start", "position_start",
                            f"transform(ancestors, x -> named_struct('start', {sum(starts)}L - x.start, 'length', x.length)) AS ancestors")
    right, swapped = ({r.conv_id: r.turns_sha256 for r in chat_tree.read_back(few, t, path).collect()} for t in (tree, wrong))
    assert set(right) == set(swapped) == {1, 2} and all(right[c] != swapped[c] for c in right)


def test_pipeline_near_duplicates_of_one_id(spark, sf):
    import corpus_pipeline

    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]

    def kept(*rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
        return sorted((r.doc_id, r.text) for r in stage(spark, frame, sf).collect())

    assert kept((5, a), (5, b), (9, b), (9, b), (7, c), (7, c)) == [(5, a), (5, b), (7, c)]
    # The second text of an id whose group has a smaller id goes, its first stays.
    assert kept((5, a), (5, b), (3, b), (8, a)) == [(3, b), (5, a)]


def test_pipeline_quality_without_labels(spark, sf, docs):
    import corpus_pipeline
    from offerline.llm import common

    folder = tempfile.mkdtemp(prefix="offerline-llm-labels-")
    write([], folder, "labels", schema=pq.read_schema(f"{SF}/labels.parquet"))
    got = dict(corpus_pipeline.STAGES)["quality_classifier"](spark, common.table(spark, sf, "documents"), folder)
    assert tuple(got.columns) == corpus_pipeline.COLUMNS and got.count() == len(docs)


def test_op2_batches_spread_over_shards(spark, sf):
    from pyspark.sql import functions as F

    from offerline.llm import suffix_dedup

    texts = spark.read.parquet(f"{sf}/documents.parquet").select(F.monotonically_increasing_id().alias("rid"), F.coalesce("text", F.lit("")).alias("t"))
    messages = suffix_dedup.anchor_messages(texts.repartition(64), 16, 50)
    shards = [r["n"] for r in messages.groupBy("shard").agg(F.sum(F.length("data")).alias("n")).collect()]
    assert len(shards) == 16 and max(shards) <= 2 * sum(shards) / len(shards)


def test_packing_hands_few_texts_to_a_worker_at_once(spark, monkeypatch):
    """10,000 whole texts stood in the JVM and in the worker for each task: the
    pipeline's last stage ran out of an executor's memory."""
    public_tokenizers = pytest.importorskip("public_tokenizers")

    from pyspark.sql import functions as F

    from offerline.llm import common, packing

    common.ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, store = spark.conf.get(key), [], common.materialize
    monkeypatch.setattr(common, "materialize", lambda df, label: seen.append((label, int(spark.conf.get(key)))) or store(df, label))
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    got = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    assert seen == [("pieces", packing.BATCH_ROWS)] and packing.BATCH_ROWS < int(before)
    assert spark.conf.get(key) == before
    assert got.select("doc_id").distinct().count() == 5000
