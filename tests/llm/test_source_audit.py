"""The divergence audit of sources against brute force."""

import collections
import random
import re
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
COLUMNS = ("lang", "source", "part", "item", "value", "rank")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(UPPER))


def plain(rows, min_docs=10):
    counts, held = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for r in rows:
        lang, source, words = r["lang"] or "", r["source"] or "", terms_of(r["text"])
        counts[lang, source].update(words)
        held[lang].update(set(words))
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang in {lang for lang, _ in counts}:
        kept = [t for t, n in held[lang].items() if n >= min_docs]
        own = {s: c for (x, s), c in counts.items() if x == lang}
        own_all = sum(own.values(), collections.Counter())

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(own_all)
        for s in own:
            pairs = sorted((-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode()) for o in own if o != s)
            terms = sorted((-gap(p[s][t], q[t]), t.encode()) for t in kept if own[s][t] > 0 and p[s][t] > q[t])[:10]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return out


def key(rows):
    return sorted(tuple(str(x) for x in r) for r in rows)


def odd_rows():
    rnd = random.Random(11)
    words = [f"w{chr(97 + i)}" for i in range(26)] + ["É", "é", "über", "X", "naïve", "日本"]
    rows = []
    for i in range(400):
        lang = rnd.choice(["en", "de", None, ""])
        source = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", "é", None, "Z"])
        rows.append({"doc_id": i % 350, "lang": lang, "source": source, "text": rnd.choice(["|", " ", "1"]).join(rnd.choices(words, k=rnd.randint(0, 40)))})
    rows += [{"doc_id": None, "lang": "en", "source": "empty", "text": None}, {"doc_id": 1, "lang": "xx", "source": "a", "text": "rare"},
             {"doc_id": 2, "lang": "xx", "source": "b", "text": ""}, {"doc_id": 3, "lang": "en", "source": "b", "text": "Wa WB long " * 20_000}]
    return rows + rows[:30]


def write(rows, schema=None):
    folder = tempfile.mkdtemp(prefix="offerline-audit-")
    pq.write_table(pa.Table.from_pylist(rows, schema=schema), f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("batch", [10_000, 3])
def test_op13_equals_brute_force(spark, batch, monkeypatch):
    from offerline.llm import queries, source_audit

    rows = [r | {"term": "clash", "n": 1, "p": 2, "value": None, "row": "x"} for r in odd_rows()]
    monkeypatch.setattr(source_audit, "TERMS_AT_ONCE", 10 if batch == 3 else 400_000)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)     # many trees whose corrections add up
    try:
        got = queries.QUERIES["op13_source_audit"](spark, write(rows))
        assert tuple(got.columns) == COLUMNS
        assert key(got.collect()) == key(plain(rows))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_op13_sql_equals_brute_force():
    import duckdb

    from offerline.llm.oracles import OP13

    documents = pa.Table.from_pylist(odd_rows(), schema=SCHEMA)     # read by name
    assert documents.num_rows
    assert key(duckdb.sql(OP13).fetchall()) == key(plain(odd_rows()))


def test_op13_without_documents(spark):
    from offerline.llm import queries

    assert queries.QUERIES["op13_source_audit"](spark, write([], SCHEMA)).collect() == []


def test_op13_tree_corrects_once_a_node_and_ancestor(spark):
    from offerline.llm import source_audit

    gap = lambda p, q: (p - q) ** 2 // (p + q)
    # Rows 1-2-3 twice, 1-2 once, 2-3 once.
    shares, zero = {1: 900, 2: 800, 3: 700}, {1: 10, 2: 20, 3: 30}
    rows = [("en", f"t{i}", k, shares[k], zero[k]) for i, path in enumerate([(1, 2, 3), (1, 2, 3), (1, 2), (2, 3)]) for k in path]
    got = source_audit.tree_corrections(spark.createDataFrame(rows, "lang string, term string, id int, p long, zero long"))
    both = {(a, b): gap(shares[a], shares[b]) - gap(shares[a], zero[b]) - gap(zero[a], shares[b]) + gap(zero[a], zero[b])
            for a, b in ((1, 2), (1, 3), (2, 3))}
    sums = collections.Counter()
    for r in got.collect():
        sums[r["a"], r["b"]] += r["value"]
    assert sums == {(1, 2): 3 * both[1, 2], (1, 3): 2 * both[1, 3], (2, 3): 3 * both[2, 3]}


def test_op13_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    from offerline.llm import source_audit

    n, total, v = 10**14, 3 * 10**14, 12345
    got = spark.range(1).select(source_audit.share(F.lit(n).cast("long"), F.lit(total).cast("long"), F.lit(v).cast("long"))).first()[0]
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * v)
