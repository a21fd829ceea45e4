"""Joins on a key of which some values hold a large share of the rows.

AQE splits a hot join partition only above its size bounds, and only in a join it
recognises. Here the hot keys are known before the join: one pass with a frequent-items
sketch (partial sketches, merged) names every key that holds at least ``share`` of the
rows. Each is dealt into ``ceil(its share / share)`` salts, and the other side's row is
repeated once a salt; all other rows are joined as they are.

Bounds: the sketch tracks ``TRACKED / share`` items, so its error (about 3.5 rows in as
many items) is well below half the threshold and no hot key is missed. At most ``2 / share`` keys
reach the driver and are broadcast, and the repeated rows are at most ``3 / share`` for each
row of the other side with that key. A key too many costs a few repeated rows, never a result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

SHARE = 0.001
TRACKED = 10

Hot = list[tuple[int, int]]     # (key, number of salts)


def heavy_sketch(key: str, share: float = SHARE) -> Column:
    """The aggregate behind ``heavy_keys``, for a job that aggregates these rows anyway."""
    most, tracked = math.ceil(2 / share), math.ceil(TRACKED / share)
    items = F.expr(f"approx_top_k({key}, {most}, {tracked}) FILTER (WHERE {key} IS NOT NULL)")
    return F.struct(F.count(key).alias("rows"), items.alias("items"))


def heavy_of(sketch, share: float = SHARE) -> Hot:
    """The hot keys of a collected ``heavy_sketch`` with their salts; none of no rows."""
    least = sketch["rows"] * share
    return [(i["item"], math.ceil(i["count"] / least)) for i in sketch["items"] or ()
            if i["count"] > max(least, 1)]


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> Hot:
    """Keys with more than ``share`` of the rows of ``df`` and their numbers of salts."""
    return heavy_of(df.agg(heavy_sketch(key, share).alias("s")).first()["s"], share)


def salted_join(many: DataFrame, one: DataFrame, key: str, hot: Hot, spread: str) -> DataFrame:
    """Inner join on ``key``, the hot keys' rows of ``many`` dealt out by a hash of ``spread``.

    Same rows as ``many.join(one, key)``. The salt is a function of the row, so a recomputed
    task deals its rows as the first one did. A null key joins with nothing.
    """
    if not hot:
        return many.join(one, key)
    kind = many.schema[key].dataType.simpleString()
    salts = F.broadcast(many.sparkSession.createDataFrame(hot, f"{key} {kind}, _salts int"))
    dealt = (many.join(salts, key, "left")
             .withColumn("_salt", F.when(F.col("_salts").isNull(), 0)
                         .otherwise(F.pmod(F.xxhash64(spread), F.col("_salts")).cast("int"))).drop("_salts"))
    copies = (one.join(salts, key, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
              .drop("_salts"))
    return dealt.join(copies, [key, "_salt"]).drop("_salt")
