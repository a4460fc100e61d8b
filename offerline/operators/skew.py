"""Joins whose left side may hold a third of its rows under one key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "__salt"
HOT_SHARE = 0.005       # a key with a larger share of the rows is hot: 200 keys at most
NULL_SALTS = 200


def hot_keys(df: DataFrame, on, share: float = HOT_SHARE) -> DataFrame | None:
    """(key columns, n_salts) of the keys of ``df`` with more than ``share``
    of its rows, None if there are none. Fewer than ``1 / share`` keys can
    be that frequent, and each gets at most ``1 / share`` salts, so the list
    is small whatever the input. The counts aggregate before the shuffle."""
    on = [on] if isinstance(on, str) else list(on)
    total = df.count()
    known = df.filter(_all(*[F.col(c).isNotNull() for c in on])).groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    found = known.filter(F.col("n") > F.lit(total * share)).collect()
    if not found:
        return None
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in on) + ", n_salts int"
    return df.sparkSession.createDataFrame([(*[r[c] for c in on], math.ceil(r["n"] / (total * share))) for r in found], schema)


def deal(left: DataFrame, on, hot: DataFrame | None) -> DataFrame:
    """``left`` with a salt: rows of a hot key are dealt by a hash of the
    whole row, rows with a NULL key (which match nothing) likewise."""
    on = [on] if isinstance(on, str) else list(on)
    row = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    missing = ~_all(*[F.col(f"`{c}`").isNotNull() for c in on])
    known = left.withColumn("n_salts", F.lit(1)) if hot is None else left.join(F.broadcast(hot), on, "left")
    return known.withColumn(SALT, F.when(missing, F.pmod(row, F.lit(NULL_SALTS))).otherwise(
        F.pmod(row, F.coalesce("n_salts", F.lit(1)))).cast("int")).drop("n_salts")


def repeat(right: DataFrame, on, hot: DataFrame | None) -> DataFrame:
    """``right`` with a salt: rows of a hot key once a salt, others once."""
    if hot is None:
        return right.withColumn(SALT, F.lit(0))
    on = [on] if isinstance(on, str) else list(on)
    salts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n_salts"), F.lit(1)) - 1))
    return right.join(F.broadcast(hot), on, "left").withColumn(SALT, salts).drop("n_salts")


def salted_join(left: DataFrame, right: DataFrame, on, how: str = "left", share: float = HOT_SHARE) -> DataFrame:
    """``left`` joined to ``right`` on equal names; the same rows, in the same
    number, as ``left.join(right, on, how)`` (``how``: left, inner, left_semi
    or left_anti). The left side's keys are counted first; only the right
    rows of hot keys are repeated. Left rows equal in every column share a
    salt; AQE's skew split is what is left for those.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot repeat the right side of a {how!r} join")
    on = [on] if isinstance(on, str) else list(on)
    hot = hot_keys(left, on, share)
    return deal(left, on, hot).join(repeat(right, on, hot), [*on, SALT], how).drop(SALT)


def _all(*conditions: Column) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
