"""Joins that stay balanced when one key holds a large share of the rows.

With adaptive execution's skew-join handling on (the Spark 4 default), a
sort-merge join splits an oversized key partition at run time and a plain join
is all that is needed. When it is switched off, :func:`join_splitting_hot_keys`
splits hot keys explicitly: keys with more than ``hot_key_rows`` rows on the
large side are found by a partial-aggregated count; rows of those keys join a
broadcast of just their dimension rows (no shuffle by key at all), the other
rows take the ordinary join. There can be at most ``rows / hot_key_rows`` hot
keys, so the broadcast key list has a proven bound, and the dimension is keyed,
so its hot rows are as few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A key with more rows than this on the large side of a join is treated as hot.
HOT_KEY_ROWS = 5_000_000


def adaptive_skew_handling(spark: SparkSession) -> bool:
    conf = spark.conf
    return (
        conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
        and conf.get("spark.sql.adaptive.skewJoin.enabled", "true").lower() == "true"
    )


def join_splitting_hot_keys(
    big: DataFrame, small: DataFrame, key: str, how: str = "inner", hot_key_rows: int | None = None
) -> DataFrame:
    """``big.join(small, key, how)`` for ``how`` in inner / left, skew-safe.

    Same rows as the plain join: every row of ``big`` goes to exactly one of
    the two branches and meets all rows of ``small`` with its key there.
    ``hot_key_rows`` defaults to :data:`HOT_KEY_ROWS`.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if adaptive_skew_handling(big.sparkSession):
        return big.join(small, key, how)
    hot_key_rows = HOT_KEY_ROWS if hot_key_rows is None else hot_key_rows
    keyed = big.where(F.col(key).isNotNull())
    hot = F.broadcast(keyed.groupBy(key).count().where(F.col("count") > hot_key_rows).select(key))
    hot_rows = keyed.join(hot, key, "left_semi")
    cold_rows = keyed.join(hot, key, "left_anti")
    hot_small = F.broadcast(small.join(hot, key, "left_semi"))
    joined = cold_rows.join(small, key, how).unionByName(hot_rows.join(hot_small, key, how))
    if how == "inner":
        return joined
    # A NULL key matches nothing: its rows go past the join instead of all meeting in one task.
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in small.schema if f.name != key]
    return joined.unionByName(big.where(F.col(key).isNull()).select("*", *absent))
