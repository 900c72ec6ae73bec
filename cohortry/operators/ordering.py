"""Exact order statistics that never sort a whole group in one task.

A window over a label, an experiment or the whole table would put that group into a single
task. These operators cut a group into ordered pieces first and only window inside a piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.session import one_row, settle

HEX_DIGITS = 4  # 65,536 hash buckets
ACCURACY = 10_000


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, a null key matching a null key: rows of a null group stay with their group."""
    renamed = right.select(*[F.col(k).alias(f"_right_{k}") if k in keys else F.col(k) for k in right.columns])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def key_hash(*keys: str, seed: int = 42) -> Column:
    """md5 of seed and key: uniform, and equal in every engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def _bucket(h: str | Column) -> Column:
    return F.substring(h, 1, HEX_DIGITS)


def hash_buckets(hashed: DataFrame, group: Sequence[str], h: str = "_h") -> DataFrame:
    """Rows per (group, hash bucket) with the rows before it and in the whole group.

    The windows see at most 65,536 bucket rows per group, whatever the group's size.
    """
    counts = hashed.groupBy(*group, _bucket(h).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    ordered = Window.partitionBy(*group).orderBy("_b")
    return counts.withColumns(
        {
            "_upto": F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
            "_size": F.sum("_n").over(Window.partitionBy(*group)),
        }
    ).withColumn("_before", F.col("_upto") - F.col("_n"))


#: A bucket of hashes is ranked by one task once it has no more rows.
RANKED = 100_000


def _cuts(buckets: DataFrame, group: Sequence[str], wanted: Column, h: int) -> DataFrame:
    """The bucket of each cut: its prefix of ``h`` digits, the rank wanted inside it and its rows.

    ``wanted`` is an array of structs of ``_cut`` and the rank within the group that ``buckets`` part.
    """
    inside = F.transform(wanted, lambda s: F.struct(s["_cut"].alias("_cut"), (s["_rank"] - F.col("_before")).alias("_rank"), F.col("_n").alias("_in")))
    chosen = F.filter(inside, lambda s: (s["_rank"] >= 1) & (s["_rank"] <= s["_in"]))
    return buckets.select(*group, F.col("_b").alias("_prefix"), F.inline(chosen))


def hash_thresholds(
    hashed: DataFrame, group: Sequence[str], shares: dict[str, float], h: str = "_h"
) -> DataFrame:
    """Per group, the largest hash among its first ``floor(share * size)`` rows in hash order.

    A radix search: rows are counted by the first digits of their hash, then those of the bucket that holds a cut by the
    next digits, until no such bucket has more than ``RANKED`` rows. So no task ranks more than these, whatever the
    group's size; rows with equal hashes count as one. Groups and cuts without rows get an empty threshold.
    """
    digits = HEX_DIGITS
    wanted = F.array(*[F.struct(F.lit(name).alias("_cut"), F.floor(F.col("_size") * share + 1e-9).alias("_rank")) for name, share in shares.items()])
    cuts = settle(_cuts(hash_buckets(hashed, group, h), group, wanted, digits), "cuts")
    while digits < 32 and (cuts.agg(F.max("_in")).first()[0] or 0) > RANKED:
        large, small = cuts.filter(F.col("_in") > RANKED), cuts.filter(F.col("_in") <= RANKED)
        of_prefix = hashed.select(*group, F.col(h).alias("_h"), F.substring(h, 1, digits).alias("_prefix"))
        prefixes = settle(large.select(*group, "_prefix").distinct(), "prefixes")
        rows = match(of_prefix, prefixes, [*group, "_prefix"])
        digits += HEX_DIGITS
        counts = rows.groupBy(*group, "_prefix", F.substring("_h", 1, digits).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        upto = Window.partitionBy(*group, "_prefix").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        parts = counts.withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
        found = match(parts, large, [*group, "_prefix"])
        deeper = found.filter((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_n")))
        deeper = deeper.select(*group, F.col("_b").alias("_prefix"), "_cut", (F.col("_rank") - F.col("_before")).alias("_rank"), F.col("_n").alias("_in"))
        cuts = settle(deeper.unionByName(small), "cuts")
    # Prefixes of different lengths: a row is looked up under each length that occurs.
    prefixes = F.array(*[F.substring("_h", 1, k) for k in range(HEX_DIGITS, digits + 1, HEX_DIGITS)])
    named = hashed.select(*group, F.col(h).alias("_h")).withColumn("_prefix", F.explode(prefixes))
    near = match(named, cuts, [*group, "_prefix"]).groupBy(*group, "_cut", "_rank", "_h").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*group, "_cut").orderBy("_h").rowsBetween(Window.unboundedPreceding, 0)
    exact = near.withColumn("_upto", F.sum("_n").over(upto)).filter((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank")))
    found = exact.groupBy(*group).agg(
        *[F.coalesce(F.max(F.when(F.col("_cut") == n, F.col("_h"))), F.lit("")).alias(n) for n in shares]
    )
    return settle(found, "thresholds")


def first_by_hash(df: DataFrame, group: Sequence[str], ids: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """``k`` rows per group in hash order: a reproducible sample independent of file order.

    Buckets are counted first, so only the rows up to the bucket that completes ``k`` are sorted.
    """
    hashed = df.withColumn("_h", key_hash(*ids, seed=seed))
    last = hash_buckets(hashed, group).filter(F.col("_before") < k).groupBy(*group).agg(F.max("_b").alias("_last"))
    if group:
        near = match(hashed, settle(last, "last-bucket"), list(group))
    else:
        near = hashed.withColumn("_last", last.select("_last").scalar())
    near = near.filter(_bucket("_h") <= F.col("_last"))
    w = Window.partitionBy(*group).orderBy("_h", *ids)
    return near.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_h", "_last", "_rn")


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the exact (interpolated) median of every column; nulls and NaN are skipped.

    ``percentile`` would gather every distinct value in one buffer. Here an approximate quantile
    pair brackets the middle ranks, the second pass counts the rows below the bracket and keeps
    only values inside it (about 6 / ``ACCURACY`` of the rows, combined by value on the map side).
    Those are range-partitioned, so that no task ranks all of a column's.
    """
    eps = 3.0 / ACCURACY
    clean = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    brackets = one_row(
        clean,
        *[
            F.struct(
                F.percentile_approx(c, [0.5 - eps, 0.5 + eps], ACCURACY).alias("at"), F.count(c).alias("n")
            ).alias(c)
            for c in columns
        ],
    )
    staged = clean.withColumn("_s", brackets)
    low = {c: F.col("_s")[c]["at"][0] for c in columns}
    high = {c: F.col("_s")[c]["at"][1] for c in columns}
    below = one_row(staged, *[F.count_if(F.col(c) < low[c]).alias(c) for c in columns])
    inside = [
        F.when(F.col(c).between(low[c], high[c]), F.struct(F.lit(c).alias("_col"), F.col(c).alias("_v"))) for c in columns
    ]
    counted = (
        staged.select(F.inline(F.filter(F.array(*inside), lambda s: s.isNotNull())))
        .groupBy("_col", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    pieces = settle(range_pieces(counted, "_col", "_v"), "bracket")
    earlier = Window.partitionBy("_col").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = pieces.groupBy("_col", "_piece").agg(F.sum("_n").alias("_pn")).withColumn("_before", F.coalesce(F.sum("_pn").over(earlier), F.lit(0)))
    upto_here = Window.partitionBy("_piece", "_col").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    facts = F.array(*[F.struct(F.lit(c).alias("_col"), below[c].alias("_below"), brackets[c]["n"].alias("_size")) for c in columns])
    known = df.sparkSession.range(1).select(F.inline(facts))
    upto = (
        pieces.withColumn("_own", F.sum("_n").over(upto_here))
        .join(totals.select("_col", "_piece", "_before"), ["_col", "_piece"])
        .join(known, "_col")
        .withColumn("_upto", F.col("_below") + F.col("_before") + F.col("_own"))
    )
    at = lambda rank: F.min(F.when(F.col("_upto") >= rank, F.col("_v")))
    mid = upto.groupBy("_col").agg(
        ((at(F.floor((F.col("_size") + 1) / 2)) + at(F.floor(F.col("_size") / 2) + 1)) / 2.0).alias("_m")
    )
    return mid.agg(*[F.max(F.when(F.col("_col") == c, F.col("_m"))).alias(c) for c in columns])


def range_pieces(df: DataFrame, *order: str | Column) -> DataFrame:
    """Range-partition by ``order`` and number the pieces in that order as ``_piece``."""
    return df.repartitionByRange(*[F.col(o) if isinstance(o, str) else o for o in order]).withColumn(
        "_piece", F.spark_partition_id()
    )
