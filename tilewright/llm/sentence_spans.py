"""Substring dedup by sliding runs of consecutive sentences.

Every run of several consecutive sentences is hashed: from each sentence on, the
fewest that are at least two and have at least ``min_words`` words (a sentence of
``long_words`` words is long enough alone). Words are what blanks separate, and single
characters of scripts without blanks. Runs are joined globally by hash; the
first is the one with the least (id, text hash, place), and sentences covered by
any run that is not the first of its hash are removed. Runs count as equal if 96 bits
of hashes are: 64 bring them together, 32 more are compared before anything goes.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.llm.common import configure, cut, release, semi_join, table

#: End of a sentence: marks followed by white space, or line ends.
_END = re.compile(r"(?:[.!?。！？]+[\"')\]]*\s+|[。！？]+|\n+)\s*")
#: Marks that end a piece of a sentence, and one of how many words ends one by its hash.
_PART, _WORD, CUT = tuple(",;:，；：、"), re.compile(r"(\S+)\s*"), 8
MIN_SENTENCES, MIN_WORDS, LONG_WORDS = 2, 15, 25
#: Characters that are words alone (fixed ranges of Unicode: South-East Asian, Kana, Han).
ALONE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_ALONE = re.compile(f"[{ALONE}]")
#: Bits of the index of the bitmap of repeated hashes, which has 16 MB, and of a part of it; first bits of a hash's places in it.
BITMAP_BITS, PART_BITS, PROBES = 27, 19, (0, 32)
_SEED, _BASE = 9, 0x9E3779B97F4A7C15


def sentences(text: str) -> list[str]:
    """The sentences of a text with what follows them; joined, they are the text."""
    out, last = [], 0
    for m in _END.finditer(text):
        out.append(text[last : m.end()])
        last = m.end()
    if last < len(text):
        out.append(text[last:])
    return out


def pieces(text: str) -> list[str]:
    """The sentences of a text cut further, at marks and after words that their hash chooses.

    Where a sentence is cut depends on its own words only, so a passage has the same
    pieces wherever it is, but for the words before its first cut and after its last.
    """
    out = []
    for part in sentences(text):
        last = 0
        for m in _WORD.finditer(part):
            if m[1].endswith(_PART) or zlib.crc32(m[1].encode("utf-8", "surrogatepass")) % CUT == 0:
                out.append(part[last : m.end()])
                last = m.end()
        if last < len(part):
            out.append(part[last:])
    return out


def runs(
    text: str, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS, both_ends: bool = False, fine: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First sentence, end sentence (exclusive) and hashes (64 and 32 bits in two columns) of every run of a text.

    With ``both_ends`` these are the fewest sentences up to each sentence, too, so the
    last sentences of a repeated span are in a run as the first ones are. With ``fine``,
    ``pieces`` take the place of sentences.
    """
    empty = np.zeros(0, dtype=np.int64)
    none = np.zeros((0, 2), dtype=np.int64)
    h128, kept, words, hashes = xxhash.xxh3_128_digest, [], [0], []
    alone = _ALONE.search(text) is not None if not text.isascii() else False
    n_parts = 0
    for n_parts, part in enumerate(pieces(text) if fine else sentences(text), 1):
        if plain := part.strip():  # white space alone is no sentence of a run
            kept.append(n_parts - 1)
            words.append(plain.count(" ") + 1 + (len(_ALONE.findall(plain)) if alone else 0))
            hashes.append(h128(plain.encode("utf-8", "surrogatepass"), _SEED))
    n = len(kept)
    if not n:
        return empty, empty, none
    size = np.array(words[1:])
    words = np.cumsum(words)
    start = np.arange(n)
    end = np.maximum(np.searchsorted(words, words[:-1] + min_words), start + MIN_SENTENCES)
    end = np.where(size >= long_words, start + 1, end)
    full = end <= n
    start, end = start[full], end[full]
    if both_ends:
        upto = np.arange(1, n + 1)
        back = np.minimum(np.searchsorted(words, words[1:] - min_words, side="right") - 1, upto - MIN_SENTENCES)
        back = np.where(size >= long_words, upto - 1, back)
        start, end = np.r_[start, back[back >= 0]], np.r_[end, upto[back >= 0]]
        start, end = np.unique(np.stack([start, end]), axis=1)
    # The hash of a run: its sentences' hashes as digits of a number modulo 2**64.
    up = _powers(n)
    own = np.frombuffer(b"".join(hashes), dtype=">u8").reshape(n, 2).astype(np.uint64)
    prefix = np.concatenate([np.zeros((1, 2), dtype=np.uint64), np.cumsum(own * up[0][:, None], axis=0, dtype=np.uint64)])
    keys = (prefix[end] - prefix[start]) * up[1][start][:, None]
    keys ^= keys >> np.uint64(32)
    keys[:, 1] &= np.uint64(0x7FFFFFFF)
    place = np.array([*kept, n_parts])
    return place[start], place[end - 1] + 1, keys.view(np.int64)


_power: list[np.ndarray] = [np.zeros(0, dtype=np.uint64)] * 2


def _powers(n: int) -> list[np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2**64."""
    if len(_power[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            row, p = [], 1
            for _ in range(2 * n):
                row.append(p)
                p = p * base % 2**64
            _power[k] = np.array(row, dtype=np.uint64)
    return [p[:n] for p in _power]


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def run_table(
    docs: DataFrame, id_col: str, text_col: str, min_words: int, long_words: int, both_ends: bool = False, fine: bool = False
) -> DataFrame:
    """``id``, ``th`` (hash of the whole text), ``first``, ``last``, ``h`` and ``more`` (the hashes) of every run."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [runs(t or "", min_words, long_words, both_ends, fine) for t in b.column(2).to_pylist()]
            n = [len(f[0]) for f in found]
            if not sum(n):
                continue
            at = pa.array(np.repeat(np.arange(len(n)), n))
            first, last, h = (np.concatenate(x) for x in zip(*found))
            columns = [pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(h[:, 0]), pa.array(h[:, 1], pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), *columns], names=["id", "th", "first", "last", "h", "more"]
            )
        release()

    slim = docs.select(F.col(id_col).alias("id"), _text_hash(text_col).alias("th"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"id {kind}, th long, first int, last int, h long, more int")


def _place(h: np.ndarray, shift: int) -> np.ndarray:
    return (h.view(np.uint64) >> np.uint64(shift)).astype(np.int64) & ((1 << BITMAP_BITS) - 1)


def _bitmap(hashes: DataFrame) -> bytes:
    """The bitmap of the places of all hashes; tasks make parts of it, which reach the driver as bytes."""
    mask = F.lit((1 << BITMAP_BITS) - 1)
    places = F.explode(F.array(*[F.shiftrightunsigned("h", s).bitwiseAND(mask).cast("int") for s in PROBES]))

    def part(rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << PART_BITS, dtype=np.uint8)
        bits[rows["place"].to_numpy() & ((1 << PART_BITS) - 1)] = 1
        return pd.DataFrame({"part": [int(rows["part"].iloc[0])], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    # Places are made distinct first, so a part has as many rows as bits at most.
    placed = hashes.select(places.alias("place")).distinct().withColumn("part", F.shiftright("place", PART_BITS))
    out = np.zeros((1 << (BITMAP_BITS - PART_BITS), 1 << (PART_BITS - 3)), dtype=np.uint8)
    for r in placed.groupBy("part").applyInPandas(part, "part int, bits binary").toLocalIterator():
        out[r["part"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out.tobytes()


def _passed(every: DataFrame, bitmap: bytes) -> DataFrame:
    """The runs whose hash is in the bitmap."""
    shared = every.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.uint8)
        for b in batches:
            h = b.column(b.schema.get_field_index("h")).to_numpy(zero_copy_only=False)
            able = np.ones(len(h), dtype=bool)
            for shift in PROBES:
                place = _place(h, shift)
                able &= bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
            if able.any():
                yield b.filter(pa.array(able))
        release()

    return every.mapInArrow(run, every.schema)


def removals(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    long_words: int = LONG_WORDS,
    both_ends: bool = False,
    fine: bool = False,
) -> DataFrame:
    """``id``, ``th`` and ``spans`` (array of first and last sentence) of the texts that lose sentences."""
    configure(docs.sparkSession)
    every = table(run_table(docs, id_col, text_col, min_words, long_words, both_ends, fine), "runs")
    repeated = table(every.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "runs-hashes")
    # The bitmap passes all repeated runs and few others, so the exact join shuffles few runs.
    again = table(_passed(every, _bitmap(repeated)).join(repeated, "h", "left_semi"), "runs-repeated")
    where = F.struct("id", "th", "first")
    firsts = cut(again.groupBy("h", "more").agg(F.min(where).alias("origin")))
    later = again.join(firsts, ["h", "more"]).where(
        ~(F.col("id").eqNullSafe(F.col("origin.id")) & (F.col("th") == F.col("origin.th")) & (F.col("first") == F.col("origin.first")))
    )
    # A text's runs are as many as its sentences at most, or twice as many.
    return later.groupBy("id", "th").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    long_words: int = LONG_WORDS,
    both_ends: bool = False,
    fine: bool = False,
) -> DataFrame:
    """All rows and columns of ``docs`` with repeated sentences removed from the text, and ``n_removed`` (long).

    A text that loses nothing stays as it is, null or empty ones too; one that
    loses all becomes the empty text. Repeated rows (equal id and text) count as one
    and share their fate. Null ids come first in the order of runs. An empty table
    gives an empty table. A column of the input named ``n_removed`` is replaced.
    ``both_ends`` and ``fine`` are those of ``runs``.
    """
    gone = removals(docs, id_col, text_col, min_words, long_words, both_ends, fine)

    marks = table(gone.select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("spans").alias("__spans")), "spans")
    # Only texts that lose sentences are joined with their spans and go through Python; the others stay where they are.
    whole = semi_join(docs, marks, id_col, text_col, "left_anti").withColumn("n_removed", F.lit(0).cast("long"))
    some = semi_join(docs, marks, id_col, text_col).withColumn("__text", _text_hash(text_col))
    joined = some.join(marks, some[id_col].eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__th")))
    counted = F.size(F.array_distinct(F.flatten(F.transform("__spans", lambda x: F.sequence(x["first"], x["last"] - 1)))))
    cut_down = joined.withColumn("n_removed", counted.cast("long")).withColumn(
        text_col, _remove_all(F.col(text_col), F.col("__spans"), F.lit(fine))
    )
    return whole.unionByName(cut_down.select(*whole.columns))


def remove(text: str, spans: list, fine: bool = False) -> str:
    """The text without the sentences (or pieces) of ``spans`` (pairs of first and end)."""
    gone: set[int] = set()
    for s in spans:
        gone.update(range(s["first"], s["last"]))
    return "".join(p for i, p in enumerate(pieces(text) if fine else sentences(text)) if i not in gone)


@F.pandas_udf(T.StringType())
def _remove_all(texts: pd.Series, spans: pd.Series, fine: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else remove(t, s, f) for t, s, f in zip(texts, spans, fine)], dtype=object)
