"""Parts of the n-gram model: message coding, n-grams of large blocks, the
scale of quantised probabilities, very long texts."""

import tempfile

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from offerline.llm import ngram_lm as m

small = st.integers(0, 5) | st.integers(0, 2**40)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(small, small, small)))
def test_messages_are_read_back(rows):
    columns = [np.array(x, np.int64) for x in zip(*sorted(rows))] if rows else [np.zeros(0, np.int64)] * 3
    coded = m.steps(*columns)
    assert all((x >= 0).all() for x in coded)
    data = m._unpacked(m._packed(a=coded[0], b=coded[1], c=coded[2], names=["x"], held=np.array([True, False])))
    for got, want in zip(m.from_steps(data["a"], data["b"], data["c"]), columns):
        assert got.tolist() == want.tolist()
    assert data["names"] == ["x"] and data["held"].tolist() == [True, False]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 7)] * 3), min_size=1))
def test_blocks_of_any_vocabulary(rows):
    h1, h2, w = (np.array(x, np.int64) for x in zip(*rows))
    for room in (63, 8):        # 8 bits hold two numbers of 3 bits, not three
        *columns, at = m.distinct_rows(h1, h2, w, 3, room)
        distinct = list(zip(*[x.tolist() for x in columns]))
        assert distinct == sorted(set(rows))
        assert [distinct[i] for i in at] == rows


def test_wide_vocabulary():
    """Numbers of 25 bits: three of them are more than 63 bits."""
    top = (1 << 25) - 1
    rows = [(top, top, top), (top, top, 0), (0, top, top), (top, top, top)]
    *columns, at = m.distinct_rows(*(np.array(x, np.int64) for x in zip(*rows)), 25)
    assert list(zip(*[x.tolist() for x in columns])) == sorted(set(rows)) and at[0] == at[3]


def test_rare_successors_of_frequent_words():
    """A successor seen once in 10 ** 11 keeps its probability, within a step."""
    n = np.array([10**11, 1], np.int64)
    at = np.zeros(2, np.int64)
    with tempfile.TemporaryFile() as file:
        m.TrieShard.write(file, (at + 5, at + 6, np.array([7, 8]), n), (at + 5, np.array([7, 8]), n), 0.5, 0.5)
        trie = m.TrieShard(file)
        a3, l3, a2, l2 = m.values_of(trie.query(at + 5, at + 6, np.array([7, 8])), trie.per_decade)
    step = 10 ** (1 / trie.per_decade)
    for got, want in ((a3[1], 0.5 / n.sum()), (a2[1], 0.5 / n.sum()), (l3[0], 1 / n.sum()), (a3[0], (n[0] - 0.5) / n.sum())):
        assert got <= want * (1 + 1e-9) and got * step >= want * (1 - 1e-9)
    assert m.scale(np.array([0.5, 1e-5])) == m.PER_DECADE


def test_one_very_long_text(spark):
    """One text far beyond a block's size is a block of its own and has the
    counts of its words."""
    text = " ".join(f"w{i % 50_000}" for i in range(400_000))
    from pyspark.sql import functions as F

    got = m.scores(spark.createDataFrame([(1, text), (2, "w1 w2 w3"), (3, None)], "doc_id long, text string"), F.lit(True)).toPandas()
    got = got.set_index("id")
    assert got.n_tokens.to_dict() == {1: 400_001, 2: 4, 3: 1} and (got.n_known == got.n_tokens).all()
    assert got.score[2] > got.base_score[2]
