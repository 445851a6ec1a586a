"""Benchmark decontamination by spaced-seed hashing.

Fixed masks select some of the tokens of a window and ignore the others, so a
window still hashes alike after a substitution at an ignored place. Hashes of test
items and of documents are joined; around each hit the two token sequences are
aligned without gaps, and the overlap is verified by counting equal tokens.

Document hashes that are in no test item are dropped in the scan by a bitmap of
fixed size (it passes every hash of the test items, so it loses nothing); what
passes is joined exactly. A test set of any size has a bitmap of the same size.

Each text meets an item once, however often they share a hash, and equal texts are
compared once; the diagonals of a pair are found where it is verified. Items too
short for the masks have one of their own, which no token is left out of.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import configure, release, table

#: Masks over consecutive tokens: # counts, - is ignored (fixed values). Together they hit every
#: overlap of 13 to 25 tokens and every whole item of 8 to 12 of which a fifth, rounded down, is
#: substituted; a longer overlap holds one of 13 to 25 tokens with no larger share.
MASKS = ("#####", "###-##", "##-#--##")
#: Items of fewer tokens must be in a text as a whole, without substitutions.
MIN_ITEM = 8
#: A verified overlap has so many aligned tokens at least, of which this share is equal.
MIN_TOKENS, MIN_SHARE = 13, 0.8
#: Bits of the bitmap's index; the bitmap has 2 MB.
BITMAP_BITS = 24
#: First bits of a hash's places in the bitmap.
PROBES = (40, 20, 0)
#: Words whose hashes a worker remembers.
MEMORY = 60_000
#: Up to so many texts (8 bytes each) with an overlap are broadcast; more are joined by a shuffle.
BROADCAST_TEXTS = 500_000
_FACTOR = 0x9E3779B97F4A7C15
_SEED = 10


class _Hashes(dict):
    """Hashes of words (bytes) that a worker remembers."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMORY:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, _SEED) >> 1
        return h


_known = _Hashes()
#: ASCII marks and controls separate tokens; letters, digits, _ and all beyond ASCII are theirs.
_APART = bytes(c if c > 127 or chr(c).isalnum() or c == 95 else 32 for c in range(256))


#: Characters of scripts without blanks are tokens alone (fixed ranges of Unicode: South-East Asian, Kana, Han);
#: marks beyond ASCII separate tokens.
_ALONE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_MARKS = re.compile("[\u0080-\u00a9\u00ab-\u00b4\u00b6-\u00b9\u00bb-\u00bf\u00d7\u00f7\u2000-\u206f\u3000-\u303f\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")


def token_hashes(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased tokens of a text: words between marks and white space, and single characters of scripts without blanks."""
    plain = (text or "").lower()
    if not plain.isascii():
        plain = _ALONE.sub(r" \g<0> ", _MARKS.sub(" ", plain))
    words = plain.encode("utf-8", "surrogatepass").translate(_APART).split()
    return np.fromiter(map(_known.__getitem__, words), dtype=np.int64, count=len(words))


def seeds(tokens: np.ndarray, masks: Sequence[str] = MASKS) -> list[tuple[np.ndarray, int]]:
    """For each mask the hash of the window at every place, and the window's length; masks longer than the tokens have none."""
    out = []
    t = tokens.view(np.uint64)
    for mask in masks:
        n = len(t) - len(mask) + 1
        if n < 1:
            continue
        h = np.full(n, int("1" + mask.replace("#", "1").replace("-", "0"), 2), dtype=np.uint64)  # masks hash apart
        factor = 1
        for i, c in enumerate(mask):
            if c == "#":
                factor = factor * _FACTOR & (2**64 - 1)
                h += t[i : i + n] * np.uint64(factor)
        h ^= h >> np.uint64(31)
        h *= np.uint64(_FACTOR)
        h ^= h >> np.uint64(29)
        out.append((h, len(mask)))
    return out


def short_masks(lengths: Sequence[int]) -> list[str]:
    """Masks of short items of these numbers of tokens: all of them count."""
    return ["#" * n for n in sorted(set(lengths)) if 0 < n < MIN_ITEM]


def _place(hashes: np.ndarray, shift: int) -> np.ndarray:
    """A place of each hash in the bitmap; those of all PROBES are set for a hash of a test item."""
    return (hashes >> np.uint64(shift)).astype(np.int64) & ((1 << BITMAP_BITS) - 1)


def overlap(a: np.ndarray, b: np.ndarray, shift: int, min_tokens: int, min_share: float) -> int:
    """Tokens of the longest verified overlap of ``a`` with ``b``, where a[i] meets b[i + shift]; 0 if none.

    An overlap has ``min_tokens`` aligned tokens at least (or as many as ``b`` has, if
    fewer), and the share of equal ones.
    """
    lo, hi = max(0, -shift), min(len(a), len(b) - shift)
    need = min(min_tokens, len(b))
    if hi - lo < need or not need:
        return 0
    same = a[lo:hi] == b[lo + shift : hi + shift]
    # value[j] - value[i] >= 0 exactly if the share holds in i..j-1 (times 1000, as whole numbers).
    value = np.concatenate([[0], np.cumsum(np.where(same, 1000, 0) - round(1000 * min_share))])
    # For each end, the earliest start with a value not above: by the running minimum from the left.
    low = np.minimum.accumulate(value)
    start = np.searchsorted(-low, -value, side="left")
    length = np.arange(len(value)) - start
    best = int(length.max())
    return best if best >= need else 0


def diagonals(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All shifts at which a window of ``a`` hashes as one of ``b`` under the masks (or the item's own, if short)."""
    masks = MASKS if len(b) >= MIN_ITEM else short_masks([len(b)])
    hit = np.zeros(len(a) + len(b), dtype=bool)
    for mask in masks:
        x, y = seeds(a, [mask]), seeds(b, [mask])
        if not x or not y:
            continue
        order = np.argsort(x[0][0], kind="stable")
        ranked = x[0][0][order]
        lo, hi = np.searchsorted(ranked, y[0][0], side="left"), np.searchsorted(ranked, y[0][0], side="right")
        for j in np.flatnonzero(hi > lo).tolist():
            hit[j - order[lo[j] : hi[j]] + len(a)] = True
    return np.flatnonzero(hit) - len(a)


def longest_overlap(a: np.ndarray, b: np.ndarray, min_tokens: int, min_share: float) -> int:
    """Tokens of the longest verified overlap of a text's tokens with an item's; 0 if none."""
    share = min_share if len(b) >= MIN_ITEM else 1.0
    return max((overlap(a, b, s, min_tokens, share) for s in diagonals(a, b).tolist()), default=0)


def _seed_rows(rows: DataFrame, id_col: str, text_col: str, masks: Sequence[str], bitmap: bytes | None) -> DataFrame:
    """``id``, ``th`` (hash of the text), ``tokens`` and ``hashes`` of texts that have any.

    With a bitmap these are the distinct hashes that are in it, under all ``masks``.
    Without one (for items) short items have their own mask only and others MASKS.
    """
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else np.frombuffer(bitmap, dtype=np.uint8)
        _known.clear()
        for b in batches:
            # All texts of a batch at once; windows that reach into the next text are dropped.
            each = [token_hashes(t) for t in b.column(2).to_pylist()]
            size = np.array([len(e) for e in each])
            ends = np.cumsum(size)
            if not len(ends) or not ends[-1]:
                continue
            tokens = np.concatenate(each)
            owners, hashes = [], []
            for mask in masks:
                for h, length in seeds(tokens, [mask]):
                    at = np.arange(len(h))
                    if bits is not None:
                        for shift in PROBES:
                            bit = _place(h[at], shift)
                            at = at[bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1]
                    owner = np.searchsorted(ends, at, side="right")
                    able = at + length <= ends[owner]
                    if bits is None:
                        able &= (size[owner] >= MIN_ITEM) & (mask in MASKS) | (size[owner] == length) & (mask == "#" * length)
                    owners.append(owner[able])
                    hashes.append(h[at[able]].view(np.int64))
            if not sum(map(len, owners)):
                continue
            owner, h = np.concatenate(owners), np.concatenate(hashes)
            order = np.lexsort((h, owner))
            owner, h = owner[order], h[order]
            first = np.r_[True, (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])]
            owner, h = owner[first], h[first]
            keep, starts = np.unique(owner, return_index=True)
            of = pa.array(keep)
            columns = [pa.array([each[i] for i in keep.tolist()], pa.list_(pa.int64())), pa.array(np.split(h, starts[1:]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(of), b.column(1).take(of), *columns], names=["id", "th", "tokens", "hashes"]
            )
        _known.clear()
        release()

    slim = rows.select(F.col(id_col).alias("id"), _text_hash(text_col).alias("th"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"id {kind}, th long, tokens array<long>, hashes array<long>")


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _bitmap(items: DataFrame) -> bytes:
    """The bitmap of all hashes of the items; at most 2**BITMAP_BITS places reach the driver, as bytes."""
    places = F.array(*[F.shiftrightunsigned("h", shift).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)) for shift in PROBES])
    place = items.select(F.explode("hashes").alias("h")).select(F.explode(places).alias("place")).select(F.col("place").cast("int"))
    byte = place.select(F.shiftright("place", 3).alias("byte"), F.expr("shiftleft(1, place & 7)").alias("bit"))
    bits = np.zeros(1 << (BITMAP_BITS - 3), dtype=np.uint8)
    rows = byte.groupBy("byte").agg(F.bit_or("bit").alias("bit")).toPandas()
    bits[rows["byte"].to_numpy(dtype=np.int64)] = rows["bit"].to_numpy(dtype=np.uint8)
    return bits.tobytes()


def matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    min_tokens: int = MIN_TOKENS,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """``th`` (hash of a text), ``item`` and ``tokens`` (the overlap's length) of every verified overlap of a text with an item."""
    configure(docs.sparkSession)
    every = dict.fromkeys([*MASKS, *short_masks(range(MIN_ITEM))])
    tests = table(_seed_rows(items, item_col, item_text, list(every), None).withColumnRenamed("id", "item"), "test-seeds")
    # One row for each number of tokens below MIN_ITEM that items have.
    short = tests.where(F.size("tokens") < MIN_ITEM).select(F.size("tokens").alias("n")).distinct().collect()
    masks = dict.fromkeys([*MASKS, *short_masks([r["n"] for r in short])])
    hits = table(_seed_rows(docs, id_col, text_col, list(masks), _bitmap(tests)), "hits")
    # Equal texts and equal items are one each from here on; all is computed from the two
    # written tables, which outlive lost executors.
    found = hits.select("th", F.explode("hashes").alias("h")).distinct()
    by_hash = tests.select(F.col("th").alias("item_th"), F.explode("hashes").alias("h")).distinct()
    pairs = found.join(by_hash, "h").select("th", "item_th").distinct()
    texts = hits.groupBy("th").agg(F.first("tokens").alias("tokens"))
    of_item = tests.groupBy("th").agg(F.first("tokens").alias("item_tokens")).withColumnRenamed("th", "item_th")

    @F.pandas_udf("long")
    def longest(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(
            [longest_overlap(np.asarray(x), np.asarray(y), min_tokens, min_share) for x, y in zip(a, b)], dtype="int64"
        )

    compared = pairs.join(texts, "th").join(of_item, "item_th").select("th", "item_th", longest("tokens", "item_tokens").alias("tokens"))
    verified = compared.where("tokens > 0")
    named = tests.select("item", F.col("th").alias("item_th")).distinct()
    return verified.join(named, "item_th").select("th", "item", "tokens")


def _joined(docs: DataFrame, text_col: str, found: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with a written table of texts (``th``), which is broadcast while it is small."""
    few = found.count() <= BROADCAST_TEXTS
    keyed = docs.withColumn("__th", _text_hash(text_col))
    right = found.withColumnRenamed("th", "__bad")
    return keyed.join(F.broadcast(right) if few else right, F.col("__th") == F.col("__bad"), how)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has no verified overlap with an item.

    Null and empty texts and items overlap nothing; items of less than MIN_ITEM tokens
    overlap a text that holds them as a whole. Marks and white space separate tokens,
    and characters of scripts without blanks are tokens alone. Other values of
    ``min_tokens`` and ``min_share`` than the given ones are verified, but the masks may
    not hit all their overlaps. Equal texts share their fate, repeated rows too.
    An empty table on either side keeps all rows.
    """
    bad = table(matches(docs, items, id_col, text_col, **options).select("th").distinct(), "contaminated")
    return _joined(docs, text_col, bad, "left_anti").drop("__th")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row for each row of ``docs``: id, ``contaminated``, ``item_ids`` (sorted) and ``overlap_tokens`` (the longest).

    Cases as in ``decontaminate``; a row without overlap has an empty list and 0.
    """
    found = matches(docs, items, id_col, text_col, **options)
    per = found.groupBy("th").agg(F.array_sort(F.collect_set("item")).alias("item_ids"), F.max("tokens").alias("overlap_tokens"))
    per = table(per, "contaminated")
    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return _joined(slim, "__text", per, "left").select(
        F.col("__id").alias(id_col),
        F.col("overlap_tokens").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast(per.schema["item_ids"].dataType)).alias("item_ids"),
        F.coalesce("overlap_tokens", F.lit(0)).cast("long").alias("overlap_tokens"),
    )
