"""Quality rules as a learned decision list, in Spark expressions only.

Text statistics are Spark SQL expressions. Sequential covering learns from
the statistics of a bounded labelled sample: it grows a conjunction of
threshold conditions that separates the class ``drop`` (quality 0) from the
rest, condition by condition by information gain, prunes it on the rows held
back, keeps it if it is precise there, sets the covered rows aside and goes
on. The list becomes one ordered ``CASE WHEN`` expression.

Rows: a null or empty text has no words and every count zero; null labels and
labels without a document are not learned from; rows equal in id and text
count once in the sample, an id on many rows brings no more than the sample's
bound; without labels the list is empty and keeps what the base rules keep.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerline.llm import common

SAMPLE_PER_CLASS = 1000     # documents of each label the rules are learned from; Spark limits groups before the shuffle up to 1,000
WINDOW = 5
FEATURES = ("mean_word_chars", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "mark_share", "distinct_share")
MAX_RULES, MAX_CONDITIONS, CANDIDATES, MIN_PRECISION = 12, 3, 40, 0.9


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and the shares of ``FEATURES``, as struct column ``stats``. Filter on ``stats``
    after storing it only: a pushed-down filter repeats the expressions."""
    lost = lambda pattern: F.length(F.regexp_replace("_t", pattern, ""))
    df = docs.withColumn("_t", common.text_of(text_col))
    df = df.withColumns({
        "_h": F.transform(F.filter(F.split("_t", r"[\x20\x09-\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w)),
        "_l": F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "_c": lost(r"[\x20\x09-\x0D]+"),
        "_s": lost(r"[^#*$%&|<>]+"),
        "_u": lost(r"\P{Lu}+"),
        "_m": lost(r"[^!-/:-@\[-`{-~]+"),
    })
    df = df.withColumn("_n", F.size("_h").cast("long"))
    df = df.withColumn("_w", F.when(F.col("_n") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.col("_n").cast("int") - WINDOW),
        lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WINDOW)]))))
    # Windows found twice or more: equal neighbours once (hash, place) is sorted.
    df = df.withColumn("_p", F.when(F.size(F.array_distinct("_w")) < F.size("_w"), F.sort_array(
        F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    again = F.filter("_p", lambda x, i: ((i > 0) & (F.get("_p", i - 1)["h"] == x["h"])) | F.coalesce(F.get("_p", i + 1)["h"] == x["h"], F.lit(False)))
    df = df.withColumn("_q", F.sort_array(F.transform(again, lambda x: x["p"])))
    covered = F.transform("_q", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_q", i + 1) - p, F.lit(WINDOW))))
    df = df.withColumn("_r", F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0).cast("long")))
    n, chars = F.greatest("_n", F.lit(1)), F.greatest("_c", F.lit(1))
    lines = F.size("_l")
    dup = (lines - F.size(F.array_distinct("_l"))).cast("long")
    stats = F.struct(
        F.col("_n").alias("n_words"), F.col("_c").cast("long").alias("word_chars"), F.col("_s").cast("long").alias("n_symbols"),
        dup.alias("n_dup_lines"), F.col("_r").alias("n_repeat_words"),
        (F.col("_c") / n).alias("mean_word_chars"), (F.col("_s") / n).alias("symbol_share"), (dup / F.greatest(lines, F.lit(1))).alias("dup_line_share"),
        (F.col("_r") / n).alias("repeat_share"), (F.col("_u") / chars).alias("upper_share"), (F.col("_m") / chars).alias("mark_share"),
        (F.size(F.array_distinct("_h")) / n).alias("distinct_share"))
    return df.withColumn("stats", stats).drop("_t", "_h", "_l", "_c", "_s", "_u", "_m", "_n", "_w", "_p", "_q", "_r")


def base_failed() -> Column:
    """Fewer than 10 words, or over a fifth of them in repeated windows."""
    return (F.col("stats.n_words") < 10) | (100 * F.col("stats.n_repeat_words") > 20 * F.col("stats.n_words"))


def labelled(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality") -> list:
    """[(values of FEATURES, drop, prune)] of a bounded labelled sample, at
    most ``per_class`` distinct documents of each class, those of the smallest
    id hash."""
    marked = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id"))
              .agg(F.min(label_col).alias("g")))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), common.text_of(text_col).alias("t"))
    known = common.materialize(marked.join(rows.select("id").distinct(), "id", "left_semi").select("g", "id"), "labelled")
    sample = common.sample_texts(rows, known, per_class, "rules").withColumnRenamed("g", "y")
    found = statistics(sample, "t").select("y", "r", base_failed().alias("failed"), *[f"stats.{f}" for f in FEATURES]).collect()
    return [(tuple(float(r[f]) for f in FEATURES), r["y"] == 0, r["r"] % 3 == 0)
            for r in sorted(found, key=lambda r: (r["y"], r["r"])) if not r["failed"]]


def holds(rule: list, values: tuple) -> bool:
    return all(values[f] >= cut if up else values[f] <= cut for f, up, cut in rule)


def grow(rows: list) -> list:
    """The conjunction with the best gain, a condition at a time."""
    rule: list = []
    while len(rule) < MAX_CONDITIONS:
        bad = [v for v, drop, _ in rows if drop]
        good = [v for v, drop, _ in rows if not drop]
        if not bad or not good:
            break
        now, best = math.log2(len(bad) / len(rows)), (1e-9, None)
        for f in range(len(FEATURES)):
            values = sorted({v[f] for v, _, _ in rows})
            cuts = values if len(values) <= CANDIDATES else [values[i * (len(values) - 1) // (CANDIDATES - 1)] for i in range(CANDIDATES)]
            for cut in cuts:
                for up in (True, False):
                    p = sum(v[f] >= cut if up else v[f] <= cut for v in bad)
                    n = sum(v[f] >= cut if up else v[f] <= cut for v in good)
                    gain = p * (math.log2(p / (p + n)) - now) if p else 0
                    if gain > best[0]:
                        best = (gain, (f, up, cut))
        if best[1] is None:
            break
        rule.append(best[1])
        rows = [r for r in rows if holds([best[1]], r[0])]
    return rule


def worth(rule: list, rows: list) -> float:
    """Share of covered rows that are to be dropped, less the others."""
    covered = [drop for v, drop, _ in rows if holds(rule, v)]
    return (2 * sum(covered) - len(covered)) / (len(covered) + 1) if covered else -1.0


def learn(rows: list) -> list[list]:
    """The decision list: rules of (feature number, at least?, threshold)."""
    out: list[list] = []
    left = rows
    while len(out) < MAX_RULES:
        grown = grow([r for r in left if not r[2]])
        held = [r for r in left if r[2]]
        rule = max((grown[:k] for k in range(len(grown), 0, -1)), key=lambda x: worth(x, held), default=[])
        covered = [drop for v, drop, _ in held if rule and holds(rule, v)]
        if len(covered) < 3 or sum(covered) < MIN_PRECISION * len(covered):
            break
        out.append(rule)
        left = [r for r in left if not holds(rule, r[0])]
    return out


def verdict(rules: list[list]) -> Column:
    """The list as one ordered expression: false where a rule drops."""
    out = F
    for rule in rules:
        fits = F.lit(True)
        for f, up, cut in rule:
            value = F.col(f"stats.{FEATURES[f]}")
            fits = fits & (value >= cut if up else value <= cut)
        out = out.when(fits, False)
    return F.lit(True) if out is F else out.otherwise(True)
