"""Reproducible shuffle and sharding by a Feistel permutation (DataFrame functions only).

Rows get global row numbers 0..n-1 in the order of their key. A generalised
Feistel network permutes the grid of ``a * b >= n`` cells (``a`` and ``b`` near
the square root of ``n``), and cycle walking repeats it until the value falls
below ``n``; so it is a bijection of the row numbers. Permuted number ``y`` gives
``shard = y % shards`` and ``slot = y div shards``: shard sizes differ by one row
at most, slots have no gaps, and both can be computed from a row's number alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.llm.common import cut

#: Prime modulus and multipliers of the round function (fixed values).
PRIME = 2**31 - 1
MULTIPLIERS = (48271, 69621)
#: Rounds of the network.
ROUNDS = 6
#: Bound of cycle walking. Less than ``a`` cells lie outside the rows, so a walk
#: of w steps has a probability below ``(1 / sqrt(n)) ** w``; where all outside
#: cells are fewer than this, the walk is complete by construction.
WALK = 48
_INDEX_BITS = (1 << 33) - 1


def grid(n: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid with ``n`` cells at least."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def round_keys(seed: int) -> list[int]:
    """Keys of the rounds, from a linear congruential sequence."""
    keys, state = [], (seed % (PRIME - 1)) + 1
    for _ in range(ROUNDS):
        state = state * MULTIPLIERS[0] % PRIME
        keys.append(state)
    return keys


def _mix(value: Column, key: Column) -> Column:
    """The round function; every product stays below 2**62."""
    first = F.pmod(F.pmod(value, F.lit(PRIME)) * F.lit(MULTIPLIERS[0]) + key, F.lit(PRIME))
    squared = F.pmod(first * first + key, F.lit(PRIME))
    mixed = squared.bitwiseXOR(F.shiftright(squared, 13))
    return F.pmod(mixed * F.lit(MULTIPLIERS[1]) + key, F.lit(PRIME))


def _once(cell: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the network over a cell number."""
    rest = F.pmod(cell, F.lit(b))
    state = F.array(((cell - rest) / F.lit(b)).cast("long"), rest)
    rounds = F.array(*[F.array(F.lit(i % 2).cast("long"), F.lit(k).cast("long")) for i, k in enumerate(round_keys(seed))])

    def turn(acc: Column, r: Column) -> Column:
        to_left = F.array(F.pmod(acc[0] + _mix(acc[1], r[1]), F.lit(a)), acc[1])
        to_right = F.array(acc[0], F.pmod(acc[1] + _mix(acc[0], r[1]), F.lit(b)))
        return F.when(r[0] == 0, to_left).otherwise(to_right)

    return F.aggregate(rounds, state, turn, lambda acc: acc[0] * F.lit(b) + acc[1])


def permuted(number: Column, n: int, seed: int = 0) -> Column:
    """The place of row ``number`` (0 <= number < n) in the shuffle."""
    a, b = grid(n)
    walk = F.sequence(F.lit(1), F.lit(max(1, min(WALK, a * b - n))))
    landed = F.aggregate(
        walk,
        _once(number, a, b, seed),
        lambda acc, _: F.when(acc < n, acc).otherwise(_once(acc, a, b, seed)),
    )
    return F.when(landed < n, landed).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def row_numbers(df: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """Dense global numbers from 0 in the order of ``order``, and the row count.

    Rows are sorted by range partitioning; their place in the sorted parts and the
    parts' sizes give the numbers. Only one row per part meets in one task. Rows
    equal in all of ``order`` and the rest are interchangeable; ties go by the
    place in the input, so a hot key spreads over parts.
    """
    tie = "__tie"
    placed = (
        df.withColumn(tie, F.monotonically_increasing_id())
        .sort(*[F.col(c).asc_nulls_first() for c in order], tie)
        .drop(tie)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__index", F.monotonically_increasing_id().bitwiseAND(F.lit(_INDEX_BITS)))
    )
    placed = cut(placed)
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    n = sizes.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0]
    # One row for each part of the sort: its number is bounded by the shuffle's parts.
    numbered = placed.join(F.broadcast(starts.select("__part", "__start")), "__part")
    return numbered.withColumn(name, F.col("__start") + F.col("__index")).drop("__part", "__index", "__start"), n


def feistel_shards(
    docs: DataFrame,
    shards: int = 24,
    seed: int = 20_24,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Shard and slot of every row under the law ``rows``.

    Returns the id, ``size`` (UTF-8 bytes of the text plus 8; a null text has
    none), ``text_crc32`` (unsigned; null text: as the empty text), ``law``,
    ``shard``, ``slot`` and ``grown_shard`` (null: only the law ``key`` has it).

    Row numbers follow (id, crc, size, a hash of the text), nulls first. Equal
    rows are interchangeable, so the result is the same multiset whatever the
    input's layout. An empty table gives an empty table. Other columns of the
    input, whatever their names, are not read.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias(id_col),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("__text"),
    )
    numbered, n = row_numbers(slim, [id_col, "text_crc32", "size", "__text"], "__row")
    place = numbered.withColumn("__place", permuted(F.col("__row").cast("long"), max(1, n), seed))
    return place.select(
        id_col,
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod("__place", F.lit(shards)).cast("int").alias("shard"),
        ((F.col("__place") - F.pmod("__place", F.lit(shards))) / F.lit(shards)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
