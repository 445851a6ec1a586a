"""Running numbers, caps, splits and samples in a global order, without a one-task sort.

Rows are bucketed by a monotone function of the order. Rows are numbered in each
bucket, and buckets' counts (a small table) give the numbers before each.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Hex digits of a hash key that name its bucket.
HASH_DIGITS = 3
#: Neighbouring ids in a bucket.
ID_STEP = 65_536


def numbered(rows: DataFrame, bucket: Column, order: list[str], name: str = "idx", of: list[str] | None = None) -> DataFrame:
    """``name``: the number, from 0, of each row in (bucket, order), in each group ``of``. Null keys are numbered, too, first."""
    of = of or []
    keyed = rows.withColumn("__bucket", bucket)
    counts = keyed.groupBy(*of, "__bucket").agg(F.count(F.lit(1)).alias("__rows"))
    before = W.partitionBy(*of).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*of, "__bucket", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    rank = F.row_number().over(W.partitionBy(*of, "__bucket").orderBy(*order))
    ranked = _with_starts(keyed.withColumn("__rank", rank), starts, [*of, "__bucket"])
    return ranked.withColumn(name, F.col("__start") + F.col("__rank") - 1).drop("__bucket", "__start", "__rank")


def _with_starts(rows: DataFrame, starts: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``__start`` of their bucket; nulls are keys like any other."""
    named = starts.select(*[F.col(k).alias(f"__of{i}") for i, k in enumerate(keys)], "__start")
    same = [F.col(k).eqNullSafe(F.col(f"__of{i}")) for i, k in enumerate(keys)]
    return rows.join(named, reduce(and_, same)).drop(*[f"__of{i}" for i in range(len(keys))])


def by_id(rows: DataFrame, key: str, order: list[str] | None = None, name: str = "idx", of: list[str] | None = None) -> DataFrame:
    """Numbers in the order of a whole-number key."""
    return numbered(rows, F.floor(F.col(key) / ID_STEP), order or [key], name, of)


def shuffle_key(seed: int, name: Column) -> Column:
    """A reproducible sort key for a shuffle."""
    return F.md5(F.concat(F.lit(f"{seed}:"), name.cast("string")))


def shuffled(rows: DataFrame, key: str, seed: int, name: str = "idx") -> DataFrame:
    """Numbers in a reproducible random order of ``key``."""
    keyed = rows.withColumn("__key", shuffle_key(seed, F.col(key)))
    return numbered(keyed, F.substring("__key", 1, HASH_DIGITS), ["__key", key], name).drop("__key")


def prefix_split(rows: DataFrame, key: str, seed: int = 13, train: float = 0.8) -> DataFrame:
    """``split``: the first ``int(n * train)`` rows of a shuffle are ``train``, the others ``val``."""
    n = rows.count()
    return shuffled(rows, key, seed).withColumn("split", F.when(F.col("idx") < int(n * train), "train").otherwise("val"))


def unit_interval(seed: int, key: Column) -> Column:
    """A reproducible uniform number below 1, from 32 bits of the shuffle key."""
    return F.conv(F.substring(shuffle_key(seed, key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def bernoulli_split(rows: DataFrame, key: str, seed: int = 13, val: float = 0.2) -> DataFrame:
    """``split`` by a reproducible draw for each key."""
    return rows.withColumn("split", F.when(unit_interval(seed, F.col(key)) < val, "val").otherwise("train"))


def sample_k(rows: DataFrame, key: str, k: int = 100, seed: int = 42) -> DataFrame:
    """``k`` rows (all, if fewer) of a reproducible shuffle."""
    return rows.orderBy(shuffle_key(seed, F.col(key)), key).limit(k)


def capped(rows: DataFrame, key: str, cap: int, order: list[str] | None = None, of: list[str] | None = None) -> DataFrame:
    """The first ``cap`` rows in order; 0 keeps all."""
    return by_id(rows, key, order, "idx", of).where(F.col("idx") < cap) if cap else by_id(rows, key, order, "idx", of)


def running_cutoff(rows: DataFrame, key: str, amount: str, cap: int) -> DataFrame:
    """Rows in the order of ``key`` up to and with the one whose running sum reaches ``cap``."""
    bucket = F.floor(F.col(key) / ID_STEP)
    keyed = rows.withColumn("__bucket", bucket)
    sums = keyed.groupBy("__bucket").agg(F.sum(amount).alias("__sum"))
    ahead = W.orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("__bucket", F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__start"))
    inside = W.partitionBy("__bucket").orderBy(key).rowsBetween(W.unboundedPreceding, 0)
    run = _with_starts(keyed, starts, ["__bucket"]).withColumn("running", F.col("__start") + F.sum(amount).over(inside))
    return run.where(F.col("running") - F.col(amount) < cap).drop("__bucket", "__start")


def fraction(rows: DataFrame, key: str, share: float, seed: int = 13) -> DataFrame:
    """A reproducible share of the rows, by a draw for each key."""
    return rows.where(unit_interval(seed, F.col(key)) < share)


def round_robin(rows: DataFrame, key: str, workers: int) -> DataFrame:
    """``worker``: the row's number modulo the workers."""
    return by_id(rows, key).withColumn("worker", F.pmod(F.col("idx"), F.lit(workers)).cast("int"))
