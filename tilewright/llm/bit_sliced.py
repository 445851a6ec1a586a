"""Exact top-k search by inner product on a bit-sliced index.

The index holds blocks of up to ROWS vectors. Quantised components are stored as
bit slices: for each dimension and each binary place one bitmap over the block's
rows (values are raised by an offset so that they are never negative). A query's
scores on a block are made by adding slices with bitmap arithmetic: a weight is
written with digits 1, 0 and -1, no two of them together, and every digit adds that
dimension's slices (complemented for -1) at its place, through carry-save adders.
The best rows are taken from the most significant slice of the sums downward, and
rows equal to the boundary score are resolved exactly, by the smaller id.

Slices are as many as the sums need, so scores are exact whatever the components;
a score among the best that is no 64-bit integer is an error.

Queries (a stated set) meet the blocks in a grid of query blocks and row blocks.
Every query meets every block, so what is shuffled is a block for each query block
and the other way round; both are megabytes, so that is few bytes for a pair of a
query and a row. Each block's best ``k`` are merged by a window that keeps ``k`` rows
of a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.llm.common import configure, table

#: Vectors in a block of the index at most; query vectors in a block, at least and at most.
ROWS, QUERIES = 65_536, (128, 4096)
#: Cells of the grid that are worth a task each, for every core.
CELLS = 4
#: Quantised components from here on are an error: they are no 64-bit integers with room for a sign and a difference.
LARGEST = 2**62


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null if the vector takes no part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))

    def whole(x: Column) -> Column:
        value = F.floor(F.lit(float(scale)) * x.cast("double"))
        error = F.raise_error(F.lit("a quantised component is beyond 2**62")).cast("long")
        return F.when(F.abs(F.lit(float(scale)) * x.cast("double")) < F.lit(float(LARGEST)), value).otherwise(error)

    return F.when(finite, F.transform(vector, whole))


def digits(weight: int) -> list[tuple[int, int]]:
    """(place, digit) of a whole number in digits 1 and -1, no two at neighbouring places."""
    out, place = [], 0
    while weight:
        if weight & 1:
            d = 2 - (weight & 3)
            out.append((place, d))
            weight -= d
        weight >>= 1
        place += 1
    return out


def _bitmaps(bits: np.ndarray) -> np.ndarray:
    """Each column of 0 and 1 as a bitmap of 64-bit words."""
    n, columns = bits.shape
    out = np.zeros((columns, -(-n // 64) * 8), dtype=np.uint8)
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)


def add_slices(columns: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Binary places of the sum: ``columns[i]`` are bitmaps of weight 2**i. Full adders carry into the next place."""
    out: list[np.ndarray] = []
    i = 0
    while i < len(columns):
        stack = list(columns[i])
        carry: list[np.ndarray] = columns[i + 1] if i + 1 < len(columns) else []
        while len(stack) > 2:
            a, b, c = stack.pop(), stack.pop(), stack.pop()
            half = a ^ b
            carry.append((a & b) | (half & c))
            half ^= c
            stack.append(half)
        if len(stack) == 2:
            a, b = stack
            carry.append(a & b)
            stack = [a ^ b]
        if i + 1 >= len(columns) and carry:
            columns.append(carry)
        out.append(stack[0] if stack else None)
        i += 1
    return out


class Block:
    """A block of vectors as bit slices, rows in the order of their id."""

    def __init__(self, ids: np.ndarray, low: int, slices: np.ndarray) -> None:
        self.ids, self.low, self.slices = ids, low, slices
        self.n, (self.dims, self.places, self.words) = len(ids), slices.shape
        self.full = _bitmaps(np.ones((self.n, 1), dtype=np.uint8))[0]

    @classmethod
    def of(cls, ids: np.ndarray, values: np.ndarray) -> "Block":
        """The block of these vectors (one in a row)."""
        order = np.argsort(ids, kind="stable")
        values = values[order].astype(np.int64)
        low = int(values.min(initial=0))
        raised = (values - low).view(np.uint64)
        places = max(1, int(raised.max(initial=0)).bit_length())
        slices = np.stack([_bitmaps((raised >> np.uint64(p) & np.uint64(1)).astype(np.uint8)) for p in range(places)], axis=1)
        return cls(ids[order], low, slices)

    def bytes(self) -> bytes:
        """Low value, dimensions and places as longs, then the slices."""
        return np.array([self.low, self.dims, self.places], dtype="<i8").tobytes() + self.slices.astype("<u8").tobytes()

    @classmethod
    def read(cls, ids: bytes, block: bytes) -> "Block":
        own = np.frombuffer(ids, dtype="<i8")
        low, dims, places = np.frombuffer(block[:24], dtype="<i8").tolist()
        return cls(own, low, np.frombuffer(block, dtype="<u8", offset=24).reshape(dims, places, -(-len(own) // 64)))

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of every row's score, raised so that none is negative, and by how much.

        The score is sum q*v = sum q*(v - low) + low * sum q. A negative digit's
        slices are complemented: -u = (2**places - 1 - u) - (2**places - 1).
        """
        columns: list[list[np.ndarray]] = []
        weights = query.tolist()[: self.dims]
        base = self.low * sum(weights)
        top = (1 << self.places) - 1
        for d, weight in enumerate(weights):
            own = list(self.slices[d])
            other = None
            for place, digit in digits(weight):
                if digit < 0:
                    if other is None:
                        other = [~s for s in own]
                    base -= top << place
                while len(columns) < place + self.places:
                    columns.append([])
                for p, s in enumerate(own if digit > 0 else other):
                    columns[place + p].append(s)
        return [s if s is not None else np.zeros(self.words, dtype=np.uint64) for s in add_slices(columns)], base

    def best(self, query: np.ndarray, k: int, skip: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those with the id ``skip``, ties to the smaller id; unordered."""
        slices, base = self.scores(query)
        able = self.full.copy()
        if skip is not None:
            for i in range(*np.searchsorted(self.ids, [skip, skip + 1])):
                able[i >> 6] &= ~(np.uint64(1) << np.uint64(i & 63))
        sure = np.zeros(self.words, dtype=np.uint64)
        got, equal = 0, able
        for s in reversed(slices):
            upper = equal & s
            n = int(np.bitwise_count(upper).sum())
            if got + n > k:
                equal = upper
            else:
                sure |= upper
                got += n
                equal = equal & ~s
                if got == k:
                    break
        rows = self._rows(sure)
        if got < k:  # all rows of ``equal`` have the boundary score; rows are in the order of ids
            rows = np.concatenate([rows, self._rows(equal)[: k - got]])
        narrow = len(slices) < 62 and abs(base) < 2**62
        score = np.full(len(rows), base, dtype=np.int64 if narrow else object)
        for p, s in enumerate(slices):
            bit = (s[rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)
            score += bit << p if narrow else bit.astype(object) << p
        if not narrow and any(not -(2**63) <= x < 2**63 for x in score.tolist()):
            raise OverflowError("a score among the best is no 64-bit integer")
        return self.ids[rows], score.astype(np.int64)

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[: self.n])


def _blocks(slim: DataFrame, rows: int, parts: int, sliced: bool) -> DataFrame:
    """``number`` (from 0), ``ids`` and ``body`` of blocks of up to ``rows`` vectors (``id``, ``v``), dealt into so many parts first.

    The body is a sliced block, or the plain values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        held: list[np.ndarray] = []

        def pack() -> pa.RecordBatch:
            values = np.zeros((len(held), max(map(len, held))), dtype="<i8")
            for i, v in enumerate(held):
                values[i, : len(v)] = v
            own = np.concatenate(ids).astype("<i8")
            if sliced:
                block = Block.of(own, values)
                own, body = block.ids, block.bytes()
            else:
                body = values.tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([own.tobytes()], pa.binary()), pa.array([body], pa.binary())], names=["ids", "body"]
            )

        for b in batches:
            for i in range(0, b.num_rows, rows):
                part = b.slice(i, rows)
                if held and len(held) + part.num_rows > rows:
                    yield pack()
                    ids, held = [], []
                ids.append(part.column(0).to_numpy(zero_copy_only=False))
                v = part.column(1)
                flat = v.flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum(np.array(v.value_lengths()))
                held.extend(np.split(flat, ends[:-1]))
        if held:
            yield pack()

    dealt = slim.repartition(parts).mapInArrow(run, "ids binary, body binary")
    blocks = table(dealt.withColumn("at", F.monotonically_increasing_id()), "blocks")
    # Numbers are given to the blocks' places alone: a row for each ``rows`` vectors.
    numbers = blocks.select("at").withColumn("number", F.row_number().over(W.orderBy("at")) - 1)
    return table(blocks.join(numbers, "at").drop("at"), "numbered-blocks")


def _taking_part(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    slim = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"))
    return slim.where("id is not null and v is not null")


def top_inner_products(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    rows: int = ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: each query's ``k`` best rows of ``vectors``.

    A query's own id is no candidate. Ties go to the smaller id. Vectors that are
    null, or have a null or non-finite component, take no part as queries or rows;
    rows without an id neither. Missing components of shorter vectors count as 0.
    Repeated rows are candidates each; queries with the same id are answered as
    one, by the best rows of any. Components are taken exactly up to 2**62 after
    scaling, beyond which they are an error; so is a score among the best that is no
    64-bit integer. Empty tables give an empty table.
    """
    configure(vectors.sparkSession)
    every, some = _taking_part(vectors, id_col, vector_col, scale), _taking_part(queries, id_col, vector_col, scale)
    n, asked_n = every.count(), some.count()
    cells = max(1, -(-n // rows))
    # Of the grid's cells, as many as keep all cores busy; query blocks of a few thousand at scale.
    wanted = CELLS * vectors.sparkSession.sparkContext.defaultParallelism
    per = min(QUERIES[1], max(QUERIES[0], asked_n * cells // wanted))
    slabs = max(1, -(-asked_n // per))
    index = _blocks(every, rows, cells, sliced=True)
    asked = _blocks(some, per, slabs, sliced=False)
    cells, slabs = index.count(), asked.count()
    result = "query_id long, vec_id long, score long"
    # The grid of row blocks and query blocks: a group is one cell of it.
    left = index.select(F.col("number").alias("cell"), "ids", "body").withColumn(
        "slab", F.explode(F.sequence(F.lit(0), F.lit(max(0, slabs - 1))))
    )
    right = asked.select(F.col("number").alias("slab"), F.col("ids").alias("q_ids"), F.col("body").alias("q_body"))
    right = right.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(max(0, cells - 1)))))

    def answer(block: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        found = []
        for ids, body in zip(block["ids"], block["body"]):
            own = Block.read(ids, body)
            for q_ids, q_body in zip(some["q_ids"], some["q_body"]):
                named = np.frombuffer(q_ids, dtype="<i8")
                for q, v in zip(named.tolist(), np.frombuffer(q_body, dtype="<i8").reshape(len(named), -1)):
                    vec, score = own.best(v, k, q)
                    found.append((np.full(len(vec), q, dtype=np.int64), vec, score))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, dtype=np.int64)] * 3
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    # A task for each cell: the parts are as many, so few groups share one.
    grid = max(1, min(cells * slabs, 20_000))
    left, right = (x.repartition(grid, "cell", "slab") for x in (left, right))
    best = left.groupBy("cell", "slab").cogroup(right.groupBy("cell", "slab")).applyInPandas(answer, result)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
