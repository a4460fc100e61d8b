"""The prefix trie of conversations against brute force."""

import collections
import hashlib
import random
import re
import tempfile
import zlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

SCHEMA = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def order(row):
    role, text = row["role"] or "", row["text"] or ""
    return (row["turn"] is not None, row["turn"] or 0, hashlib.sha256(f"{len(role.encode())} {role}{text}".encode()).digest()[:16])


def plain(rows):
    own = collections.defaultdict(list)
    for r in sorted((r for r in rows if r["conv_id"] is not None), key=order):
        own[r["conv_id"]].append((r["role"] or "", r["text"] or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[:len(path)] == path]
        saved = sum((len(members[p]) - 1) * len(re.findall(rb"[^\x20\x09-\x0D]+", p[-1][1].encode())) for p in below if p)
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == path)
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children[path],
                    sum(children[p] == 0 for p in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def key(rows):
    return sorted(tuple(str(x) for x in r) for r in rows)


def odd_rows():
    rnd = random.Random(5)
    rows = []
    for c in [*range(0, 47), 63, -3, -25, 2**61]:       # 60 and -20 are absent
        for t in range(rnd.randint(1, 9)):
            rows.append({"conv_id": c, "turn": t, "role": rnd.choice(["user", "assistant"]), "text": rnd.choice(["a", "b c", "", None])})
    rows += [{"conv_id": 20, "turn": None, "role": None, "text": "first"}, {"conv_id": 20, "turn": None, "role": None, "text": "first"},
             {"conv_id": 3, "turn": 2, "role": "user", "text": "tie"}, {"conv_id": 3, "turn": 2, "role": "user", "text": "other tie"},
             {"conv_id": None, "turn": 0, "role": "user", "text": "no id"}, {"conv_id": 41, "turn": 0, "role": "é", "text": "w x " * 9000}]
    rows += [{"conv_id": 44, "turn": t, "role": "user", "text": "a" if t % 3 else "b"} for t in range(10, 90)]   # a third of all rows
    rows += [{"conv_id": 45, "turn": t, "role": "user", "text": "a" if t % 3 else "b"} for t in range(10, 70)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("base", [1, 8])
def test_op11_equals_brute_force(spark, base, monkeypatch):
    from offerline.llm import conversation_trie, queries

    folder = tempfile.mkdtemp(prefix="offerline-trie-")
    rows = [r | {"node": "x", "c": 7, "e": None, "k": 1} for r in odd_rows()]
    pq.write_table(pa.Table.from_pylist(rows), f"{folder}/conversations.parquet")
    monkeypatch.setattr(conversation_trie.prefixes, "__defaults__", (base,))
    monkeypatch.setattr(conversation_trie.trie, "__defaults__", (base,))
    got = queries.QUERIES["op11_conversation_trie"](spark, folder)
    assert tuple(got.columns) == COLUMNS
    assert key(got.collect()) == key(plain(rows))


def test_op11_sql_equals_brute_force():
    import duckdb

    from offerline.llm.oracles import OP11

    conversations = pa.Table.from_pylist(odd_rows(), schema=SCHEMA)     # read by name
    assert conversations.num_rows
    assert key(duckdb.sql(OP11).fetchall()) == key(plain(odd_rows()))


@pytest.mark.parametrize("rows", [[], [{"conv_id": None, "turn": 0, "role": "user", "text": "x"}]])
def test_op11_without_conversations(spark, rows):
    from offerline.llm import queries

    folder = tempfile.mkdtemp(prefix="offerline-trie-")
    pq.write_table(pa.Table.from_pylist(rows, schema=SCHEMA), f"{folder}/conversations.parquet")
    assert queries.QUERIES["op11_conversation_trie"](spark, folder).collect() == []


def test_op11_turnless_conversations(spark):
    from offerline.llm import conversation_trie

    # Sequences given by length alone end at the root.
    none = spark.createDataFrame([], "c long, i long, e binary, w long")
    nodes, ends = conversation_trie.trie(none, spark.createDataFrame([(7, 0), (5, 0)], "c long, len long"))
    row = nodes.join(conversation_trie.ends_digest(ends), "node").first()
    assert (row["conv_id"], row["depth"], row["n_convs"], row["n_leaves"]) == (5, 0, 2, 1)
    assert row["ends_sha256"] == hashlib.sha256(b"5,7").hexdigest()


def test_op11_sequences_are_spread(spark):
    """The turns of one sequence that holds nearly all rows are numbered in many tasks."""
    from offerline.llm import conversation_trie

    rows = spark.sql("SELECT 20L AS conv_id, id AS turn, 'user' AS role, CAST(id % 7 AS STRING) AS text FROM range(20000)")
    numbered = conversation_trie.turns(rows.repartition(8))
    assert numbered.agg({"pos": "max"}).first()[0] == 19_999 and numbered.select("pos").distinct().count() == 20_000
    nodes, _ = conversation_trie.trie(*conversation_trie.rebuilt(numbered))
    assert nodes.count() == 20_001
    assert nodes.filter("depth = 0").first()["n_leaves"] == 1
