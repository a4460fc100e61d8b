"""Training samples of the quality, rules and language operators: rows are
chosen, not ids, the bound holds whatever ids repeat, and the same rows give
the same sample; predictions against plain versions of the methods."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerline.llm import common, langid, quality_knn, rules

DOCS = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def hot(spark):
    """Id 1 on 20,000 rows of distinct texts, id 2 on 5,000 equal rows, null
    ids, and 60 plain ids."""
    rows = [(1, f"hot text number {i}", "en") for i in range(20_000)] + [(2, "the same text", "en")] * 5_000
    rows += [(None, "without an id", "en"), (None, None, "en")]
    rows += [(i, f"plain text of {i}", "en" if i % 2 else "fr") for i in range(3, 63)]
    labels = [(1, 0), (2, 1), (None, 0)] + [(i, i % 2) for i in range(3, 63)] + [(3, None), (10**9, 1)]
    return spark.createDataFrame(rows, DOCS).repartition(7), spark.createDataFrame(labels, "doc_id long, quality int")


def test_first_ids_equal_a_full_sort(spark):
    ids = spark.range(20_000).select((F.col("id") % 3).alias("g"), F.col("id")).union(spark.range(5).select(F.lit(7), F.col("id")))
    hashed = ids.withColumn("h", F.xxhash64(F.lit("seed"), "id")).collect()
    want = {(r["g"], r["id"]) for g in (0, 1, 2, 7) for r in sorted((r for r in hashed if r["g"] == g), key=lambda r: (r["h"], r["id"]))[:50]}
    got = [(r["g"], r["id"]) for r in common.first_ids(ids.union(ids), 50, "seed").collect()]
    assert len(got) == len(want) and set(got) == want


def test_rows_of_one_id_keep_the_bound(hot):
    docs, _ = hot
    rows = docs.select(F.col("lang").alias("g"), F.col("doc_id").alias("id"), F.col("text").alias("t")).filter("t is not null")

    def sample(**more):
        found = common.sample_texts(rows, rows.select("g", "id"), 40, "s", by_group=True, **more).collect()
        return sorted(((r["g"], r["r"], r["id"], r["t"]) for r in found), key=str)

    got = sample()
    assert collections.Counter(r[0] for r in got) == {"en": 40, "fr": 30}
    assert len({r[2:] for r in got}) == len(got)
    assert got == sample()      # whatever tasks ran first
    few = sample(max_bytes=100)
    assert set(few) < set(got) and 100 <= sum(len(r[3]) for r in few if r[0] == "fr") < 120


def test_each_operator_takes_a_bounded_sample(hot):
    docs, labels = hot
    longer = docs.withColumn("text", F.concat("text", F.lit(" one two three four five six seven eight nine ten")))
    learned = rules.labelled(longer, labels, per_class=30)
    assert learned == rules.labelled(longer, labels, per_class=30) and 0 < len(learned) <= 60
    space = quality_knn.fit(docs, labels, F.lit(True), per_class=30)
    assert collections.Counter(space.labels.tolist()) == {0.0: 30, 1.0: 30}
    again = quality_knn.fit(docs, labels, F.lit(True), per_class=30)
    assert (space.vectors == again.vectors).all() and (space.labels == again.labels).all()
    model = langid.train(docs, F.lit(True), per_language=5)
    assert set(model) == {"en", "fr"} and all(n.sum() < 5 * 40 for _, n in model.values())


def test_rows_without_an_id_are_learned_from(spark):
    docs = spark.createDataFrame([(None, "a", "x"), (None, "b", "x"), (None, "b", "x")], DOCS)
    codes, n = langid.train(docs, F.lit(True))["x"]
    assert n.sum() == 2 and {int(c) & 255 for c in codes} == {ord("a"), ord("b")}


def test_op5_votes_equal_a_plain_vote(hot):
    """Scores against cosines and votes computed pair by pair."""
    docs, labels = hot
    space = quality_knn.fit(docs, labels, F.lit(True), per_class=30)
    texts = ["plain text of 7", "hot text number 12", "something else\nsomething else", "x", ""]
    got = space.score(texts)
    for text, score in zip(texts, got):
        weights = quality_knn.term_weights([text])[0] * space.idf
        vector = (weights / max(np.linalg.norm(weights), 1e-9)) @ space.basis
        vector = vector / max(np.linalg.norm(vector), 1e-9)
        near = sorted(((float(sum(a * b for a, b in zip(vector, v))), float(y)) for v, y in zip(space.vectors, space.labels)), reverse=True)
        cut = near[quality_knn.NEIGHBOURS - 1][0]
        sure = [(c, y) for c, y in near if c > cut + 1e-5]
        ties = [y for c, y in near if abs(c - cut) <= 1e-5]
        free = quality_knn.NEIGHBOURS - len(sure)
        w = [max(c, 0) ** quality_knn.SHARPNESS for c, _ in sure]
        edge = max(cut, 0) ** quality_knn.SHARPNESS
        total = sum(w) + free * edge
        if not total:
            assert score == pytest.approx(float(space.labels.mean()), abs=1e-6)
            continue
        base = sum(x * y for x, (_, y) in zip(w, sure))
        low, high = (base + edge * sum(sorted(ties, reverse=r)[:free]) for r in (False, True))
        assert low / total - 1e-4 <= score <= high / total + 1e-4


def test_op6_kept_equals_a_plain_decision_list(spark):
    """The Spark expression of a list of several rules and conditions against
    the rules read one by one."""
    rng = np.random.default_rng(3)
    names = ["short", "a longer word here", "AGAIN AGAIN", "### ***", "line one\nline one", "mixed Case, and; marks!"]
    texts = [" ".join(rng.choice(names, rng.integers(1, 30))) for _ in range(200)] + ["", None]
    stats = rules.statistics(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    at = rules.FEATURES.index
    learned = [[(at("upper_share"), True, 0.2), (at("repeat_share"), True, 0.1)], [(at("mark_share"), True, 0.1)],
               [(at("distinct_share"), False, 0.3), (at("mean_word_chars"), False, 4.0), (at("symbol_share"), False, 0.5)]]
    rows = stats.select("doc_id", *[f"stats.{f}" for f in rules.FEATURES], rules.verdict(learned).alias("kept")).collect()

    def keeps(r):
        for rule in learned:
            if all((r[rules.FEATURES[f]] >= cut) if up else (r[rules.FEATURES[f]] <= cut) for f, up, cut in rule):
                return False
        return True

    assert len(rows) == len(texts) and all(r["kept"] == keeps(r) for r in rows)
    assert 0 < sum(r["kept"] for r in rows) < len(rows)


def test_op7_predictions_equal_a_plain_model(spark):
    """Language and score of each text from code lengths that a plain model
    with exclusions sums byte by byte."""
    train = [(1, "the cat and the hat sat", "en"), (2, "le chat et le chapeau", "fr"), (3, "the end", "en"), (4, "die katze und der hut", "de")]
    docs = spark.createDataFrame(train, DOCS)
    model = langid.train(docs, F.lit(True))
    counts = {lang: collections.defaultdict(collections.Counter) for lang in ("en", "fr", "de")}
    for _, text, lang in train:
        data = langid.START + text.encode()
        for i in range(langid.ORDER, len(data)):
            for k in range(langid.ORDER + 1):
                counts[lang][data[i - k:i]][data[i]] += 1

    def bits(lang, text):
        data, total = langid.START + text.encode(), 0.0
        for i in range(langid.ORDER, len(data)):
            gone = set()
            for k in range(langid.ORDER, -1, -1):
                seen = {b: n for b, n in counts[lang].get(data[i - k:i], {}).items() if b not in gone}
                if not seen:
                    continue
                size = sum(seen.values()) + len(seen)
                if data[i] in seen:
                    total -= math.log2(seen[data[i]] / size)
                    break
                total -= math.log2(len(seen) / size)
                gone |= set(seen)
            else:
                total += math.log2(256 - len(gone))
        return total

    texts = ["the cat", "le chat", "der hut", "zzz", "é à the", "12 34", "", None]
    rows = langid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in rows:
        text = texts[r["id"]]
        if not text or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        length = {lang: bits(lang, text) for lang in sorted(counts)}
        best = min(length, key=length.get)
        share = 1 / sum(2 ** (-(n - length[best]) * langid.SCALE) for n in length.values())
        assert r["score"] == pytest.approx(share, abs=1e-4)
        assert length[r["lang_pred"]] == pytest.approx(length[best], abs=1e-3)
