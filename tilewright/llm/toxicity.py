"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed character n-grams (of the lower-cased text, white space as
one space) that a text has, each counted once. Their log-count ratios between
toxic and clean training texts scale them (a ratio that chance explains is 0, so the
more labelled texts there are, the more features count); a logistic regression on the scaled
features, with L2 shrinkage, gives the score.

The counts behind the ratios are of all labelled texts outside the held-out fold:
tasks add them up by feature, of which there are 2**HASH_BITS. The regression is
fitted on a bounded sample: of the ``sample`` labelled rows with the least hash of
id and text, those whose features add up to SAMPLE_FEATURES. No text leaves the
executors, only numbers of features. Scoring covers all rows.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import configure, release, table

#: Lengths of n-grams, bits of their hash, weight of a feature before any text has it.
GRAMS, HASH_BITS, ALPHA = (3, 4, 5), 18, 1.0
#: Labelled rows of a fit at most, and their features together at most (4 bytes each).
SAMPLE, SAMPLE_FEATURES = 6000, 40_000_000
#: Weight of the L2 shrinkage; standard deviations from which a log-count ratio is told from chance.
SHRINK, SURE = 1.0, 2.5
#: Features that are gone through at a time in the fit, its rounds, and those of the power iteration.
BLOCK, ROUNDS, POWER = 1_000_000, 60, 8
#: Up to so many labelled ids (16 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: A score from which a text is toxic.
THRESHOLD = 0.3
_MULTIPLIER = np.uint32(2654435761)
_SPACE = re.compile(r"\s+")


def features(text: str | None) -> np.ndarray:
    """Distinct hashed n-grams of a whole text (unsorted)."""
    plain = " " + _SPACE.sub(" ", (text or "").lower()).strip() + " "
    codes = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    seen = np.zeros(1 << HASH_BITS, dtype=bool)
    for n in GRAMS:
        m = len(codes) - n + 1
        if m < 1:
            break
        h = np.full(m, n, dtype=np.uint32)
        for i in range(n):
            h ^= codes[i : i + m]
            h *= _MULTIPLIER
            h ^= h >> np.uint32(15)
        seen[h >> np.uint32(32 - HASH_BITS)] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    """Weight of each hashed feature, and the intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        z = self.intercept + float(self.weights[features(text)].sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def log_count_ratios(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log of the smoothed share of toxic texts with each feature by that of clean ones; 0 where chance explains it.

    Chance gives the logarithm a standard deviation of sqrt(1 / toxic + 1 / clean), with
    the smoothed counts; a ratio within SURE of them says nothing of its feature.
    """
    ratio = np.log(((toxic + ALPHA) / (n_toxic + 2 * ALPHA)) / ((clean + ALPHA) / (n_clean + 2 * ALPHA)))
    return np.where(np.abs(ratio) < SURE * np.sqrt(1 / (toxic + ALPHA) + 1 / (clean + ALPHA)), 0.0, ratio)


def constant(share: float) -> Model:
    """A model that knows the share of toxic texts only."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Model(np.zeros(1 << HASH_BITS, dtype=np.float32), float(np.log(share / (1 - share))))


def fit(rows: list[np.ndarray], toxic: np.ndarray, ratio: np.ndarray, shrink: float = SHRINK, rounds: int = ROUNDS) -> Model:
    """A model of texts given by their features. Without texts of both labels, the score is the share of toxic ones (or 0)."""
    y = np.asarray(toxic, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.0)
    scale = ratio.astype(np.float32)
    # Blocks of whole rows: features, how many each row has, and the rows.
    blocks, at = [], 0
    while at < len(rows):
        end, held = at, 0
        while end < len(rows) and (end == at or held < BLOCK):
            held += len(rows[end])
            end += 1
        size = np.array([len(r) for r in rows[at:end]])
        blocks.append((np.concatenate(rows[at:end]), size, slice(at, end)))
        at = end

    def gradient_of(weights: np.ndarray, bias: float, errors) -> tuple[np.ndarray, float]:
        """What ``errors`` (of scores and their rows) of the linear scores add to the weights and the bias."""
        scaled = (scale * weights).astype(np.float32)
        own, total = np.zeros(len(scale)), 0.0
        for x, size, of in blocks:
            upto = np.concatenate([[0.0], np.cumsum(scaled[x], dtype=np.float64)])
            ends = np.cumsum(size)
            error = errors(bias + upto[ends] - upto[ends - size], of)
            own += np.bincount(x, weights=np.repeat(error, size), minlength=len(scale))
            total += error.sum()
        return scale * own, total

    # Nesterov's method on the mean loss. Its step follows from the largest curvature, by power iteration.
    direction, bias, curvature = np.abs(scale).astype(np.float64), 1.0, 0.0
    for _ in range(POWER):
        size = float(np.sqrt((direction**2).sum() + bias**2)) or 1.0
        direction, bias = gradient_of(direction / size, bias / size, lambda z, _: z / len(y))
        curvature = float(np.sqrt((direction**2).sum() + bias**2))
    step = 1.0 / (0.25 * 1.1 * curvature + shrink / len(y))
    w = momentum = np.zeros(len(scale))
    b = b_momentum = float(np.log(y.mean() / (1 - y.mean())))
    for k in range(rounds):
        gradient, total = gradient_of(
            momentum, b_momentum, lambda z, of: (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y[of]) / len(y)
        )
        gradient = gradient + shrink / len(y) * momentum
        next_w, next_b = momentum - step * gradient, b_momentum - step * total
        speed = k / (k + 3)
        momentum, b_momentum = next_w + speed * (next_w - w), next_b + speed * (next_b - b)
        w, b = next_w, next_b
    return Model((w * scale).astype(np.float32), float(b))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key`` (a hash of id and text), ``text`` and ``toxic`` (0 or 1) of the rows that may be learnt from.

    Ids whose label is null, that have both labels, or that are held out are not
    learnt from; of rows with the same id each counts.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .where("toxic = most")
        .select("id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    )
    few = known.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(known) if few else known, "id")
    return rows.select(F.xxhash64("id", F.coalesce("text", F.lit(""))).alias("key"), "text", "toxic")


def feature_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Toxic and clean texts with each feature, and all toxic and clean texts."""
    size = 1 << HASH_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has = np.zeros((2, size + 1), dtype=np.int64)  # the last place counts texts
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                has[toxic, features(text)] += 1
                has[toxic, size] += 1
        some = np.flatnonzero(has.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(has[1, some]), pa.array(has[0, some])], names=["feature", "toxic", "clean"]
        )
        release()

    counted = rows.select("text", "toxic").mapInArrow(run, "feature int, toxic long, clean long")
    summed = counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers = np.stack([c.to_numpy(zero_copy_only=False).astype("<i8") for c in b.columns])
            yield pa.RecordBatch.from_arrays([pa.array([numbers.tobytes()], pa.binary())], names=["numbers"])

    # Three numbers for each feature, of which there are 2**HASH_BITS at most, as bytes.
    has = np.zeros((2, size + 1), dtype=np.int64)
    for r in summed.mapInArrow(pack, "numbers binary").collect():
        place, *both = np.frombuffer(r["numbers"], dtype="<i8").reshape(3, -1)
        has[1, place], has[0, place] = both
    return has[1, :size], has[0, :size], int(has[1, size]), int(has[0, size])


def sampled(rows: DataFrame, sample: int, ratio: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Features with a ratio, and labels, of the rows with the least keys: ``sample`` at most, with SAMPLE_FEATURES features at most."""
    counts = ratio != 0
    keys = [r["key"] for r in rows.select("key").orderBy("key").limit(sample + 1).collect()]
    # Rows with the key beyond the sample stay out, so that equal rows don't widen it.
    some = rows.where(F.col("key") < keys[sample]) if len(keys) > sample else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [f[counts[f]].astype("<i4") for f in map(features, b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(map(len, found), pa.int64()), pa.array([f.tobytes() for f in found], pa.binary())],
                names=["key", "toxic", "n", "features"],
            )
        release()

    # Numbers only, in the executors' shared folder, so that the bound is known before they are fetched.
    each = table(some.mapInArrow(run, "key long, toxic int, n long, features binary"), "toxicity-sample")
    total, last = 0, None
    for r in each.select("key", "n").orderBy("key").collect():
        total += r["n"]
        if total > SAMPLE_FEATURES:
            break
        last = r["key"]
    if last is None:
        return [], np.zeros(0)
    # A partition at a time, as it is, and in order here.
    parts = each.where(F.col("key") <= last).select("key", "toxic", "features").toLocalIterator()
    got = sorted(((r["key"], r["toxic"], bytes(r["features"])) for r in parts))
    return [np.frombuffer(x, dtype="<i4") for *_, x in got], np.array([y for _, y, _ in got], dtype=float)


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"
) -> Model:
    """A model of the labelled documents outside the held-out fold."""
    rows = labelled(docs, labels, id_col, text_col)
    toxic, clean, n_toxic, n_clean = feature_counts(rows)
    if not n_toxic or not n_clean:
        return constant(n_toxic / (n_toxic + n_clean) if n_toxic + n_clean else 0.0)
    ratio = log_count_ratios(toxic, clean, n_toxic, n_clean)
    return fit(*sampled(rows, sample, ratio), ratio)


def held_out(id_column: Column) -> Column:
    """Whether a row belongs to the held-out fold."""
    return F.coalesce(F.pmod(F.crc32(F.encode(id_column.cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))


def scorer(docs: DataFrame, model: Model):
    """A pandas UDF that scores texts; the model reaches the workers as a broadcast of fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = pickle.loads(shared.value)
        for texts in batches:
            yield pd.Series([own.score(t) for t in texts], dtype="float64")
        release()

    return F.pandas_udf(score, "double")


def toxicity(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Id, ``held_out``, ``score`` and ``predicted`` of every row.

    Null texts are empty texts and have a score, too. A row with a null id is in no
    fold and is not held out. Repeated rows stay; an empty table gives an empty
    table, and without labels all scores are 0.000001. Other columns are not read.
    """
    configure(docs.sparkSession)
    score = scorer(docs, train(docs, labels, sample, id_col, text_col))
    scored = docs.select(F.col(id_col).alias("__id"), score(F.col(text_col)).alias("score"))
    return scored.select(
        F.col("__id").alias(id_col),
        held_out(F.col("__id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
