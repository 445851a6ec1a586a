"""SimHash near-duplicates by anchor points of a covering code.

Two fingerprints link at ``threshold`` or fewer differing bits. Anchors are the
code words of a product of perfect binary Golay codes (23 bits, covering radius
3) over disjoint bit ranges of the fingerprint. Every fingerprint f has one home
anchor within the radius of each block. If g differs from f in e1 bits of the
first block and e2 of the second, f's home lies within radius + e1 and radius +
e2 of g. So each fingerprint is replicated to every anchor whose excess over the
radius, summed over the blocks, is the threshold at most; two fingerprints that
link always meet at the home of either, and are compared there.

Equal fingerprints are merged first, with a partial aggregate, so a huge group of
exact copies is one row. In an anchor's rows, links are found by comparing exact
fingerprints and are returned as a spanning forest, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import configure, cut, release, table
from tilewright.llm.graph import connected_components, forest

#: Seed of XXH64, words in a shingle (fixed values).
SEED = 42
SHINGLE = 3
#: Generator polynomial of the binary Golay code, x^11+x^9+x^7+x^6+x^5+x+1 (fixed value).
GOLAY = 0b101011100011
BITS, CHECK, RADIUS = 23, 11, 3
#: First bit of each code block in the fingerprint.
BLOCKS = (0, 23)
#: Fingerprints that a task replicates, about 60 times each.
DEALT = 50_000
#: A group of up to so many fingerprints is compared pair by pair, in blocks of rows.
BRUTE = 8192

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a whole text; 0 for null or a text without words."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    h64 = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        hashes = [h64(b" ".join(words), SEED)]
    else:
        # Words have no spaces, so joined pairs with the next word are the shingles.
        hashes = [h64(b"%b %b %b" % w, SEED) for w in zip(words, words[1:], words[2:])]
    n = len(hashes)
    lanes = np.array(hashes, dtype="<u8").view(np.uint8).reshape(n, 8)
    if n < 256:
        ones = np.unpackbits(lanes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(lanes[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", text_hash: bool = False) -> DataFrame:
    """Id and ``fp`` (the fingerprint as a signed long) of every row, and ``th`` (XXH64 of its text; a null one is empty) on request."""
    configure(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py()) for t in b.column(1)), dtype=np.uint64, count=b.num_rows)
            more = b.columns[2:]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(fps.view(np.int64)), *more], names=["id", "fp", "th"][: 2 + len(more)]
            )
        release()

    th = [F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th")] if text_hash else []
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *th)
    return slim.mapInArrow(run, f"id {id_type}, fp long" + (", th long" if text_hash else ""))


@cache
def _code() -> tuple[np.ndarray, list[np.ndarray]]:
    """The syndrome of every 23-bit word's part, and words by syndrome.

    Returns the syndromes of the 23 unit vectors, and for each excess 0..2 the
    error patterns (weight up to radius + excess) sorted by syndrome, as lists.
    """
    unit = np.zeros(BITS, dtype=np.int64)
    for i in range(BITS):
        rest = 1 << i
        for bit in range(BITS - 1, CHECK - 1, -1):
            if rest >> bit & 1:
                rest ^= GOLAY << (bit - CHECK)
        unit[i] = rest
    return unit


@cache
def _tables() -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Syndromes of each of a word's three bytes, and for each syndrome the error patterns by excess."""
    unit = _code()
    parts = []
    for start in (0, 8, 16):
        t = np.zeros(256, dtype=np.int64)
        for i in range(min(8, BITS - start)):
            t[(np.arange(256) >> i & 1) == 1] ^= unit[start + i]
        parts.append(t)
    patterns = [np.zeros(1, dtype=np.int64)]
    for w in range(1, RADIUS + 3):
        last = patterns[-1]
        grown = []
        for i in range(BITS):
            grown.append(last[last < (1 << i)] | (1 << i))
        patterns.append(np.concatenate(grown))
    by_excess, starts = [], []
    for excess in range(3):
        weights = range(RADIUS + 1) if excess == 0 else [RADIUS + excess]
        p = np.concatenate([patterns[w] for w in weights])
        s = _syndrome(p, parts)
        order = np.argsort(s, kind="stable")
        by_excess.append(p[order])
        starts.append(np.searchsorted(s[order], np.arange((1 << CHECK) + 1)))
    return parts, by_excess, starts


def _syndrome(words: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    return parts[0][words & 255] ^ parts[1][words >> 8 & 255] ^ parts[2][words >> 16 & 255]


def _near(words: np.ndarray, excess: int) -> tuple[np.ndarray, np.ndarray]:
    """Code words at exactly this excess of each word: positions in ``words``, and code words."""
    parts, by_excess, starts = _tables()
    s = _syndrome(words, parts)
    first, n = starts[excess][s], starts[excess][s + 1] - starts[excess][s]
    at = np.repeat(np.arange(len(words)), n)
    offset = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    return at, words[at] ^ by_excess[excess][first[at] + offset]


def anchors(fps: np.ndarray, threshold: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``fps`` (unsigned) and the anchors each is replicated to, its home among them."""
    if not 0 <= threshold <= 2:
        raise ValueError("threshold must be 0, 1 or 2")
    at = np.arange(len(fps))
    anchor = np.zeros(len(fps), dtype=np.int64)
    left = np.full(len(fps), threshold)
    for start in BLOCKS:
        word = (fps[at] >> np.uint64(start)).astype(np.int64) & ((1 << BITS) - 1)
        grown = []
        for excess in range(threshold + 1):
            able = np.flatnonzero(left >= excess)
            i, code = _near(word[able], excess)
            keep = able[i]
            grown.append((at[keep], anchor[keep] << BITS | code, left[keep] - excess))
        at, anchor, left = (np.concatenate(x) for x in zip(*grown))
    return at, anchor


def _find(parent: dict[int, int], x: int) -> int:
    root = x
    while (p := parent.get(root, root)) != root:
        root = p
    while (p := parent.get(x, x)) != root:
        parent[x] = root
        x = p
    return root


def _linked(group: np.ndarray, threshold: int) -> Iterator[tuple[int, int]]:
    """Links of one anchor's distinct fingerprints (unsigned), enough to connect what is linked."""
    n = len(group)
    if n <= BRUTE:
        step = max(1, 2_000_000 // n)
        for i in range(0, n - 1, step):
            rows = group[i : i + step]
            close = np.bitwise_count(rows[:, None] ^ group[None, i:]) <= threshold
            a, b = np.nonzero(close)
            keep = a < b
            yield from zip(rows[a[keep]].tolist(), group[i + b[keep]].tolist())
        return
    # A large group: fingerprints equal outside some two bits link, so each pair of
    # positions (and no pair of rows) is gone through, and equal values are chained.
    varying = np.bitwise_or.reduce(group ^ group[0])
    places = [i for i in range(64) if int(varying) >> i & 1] or [0]
    if threshold < 2 or len(places) == 1:
        masks = [1 << i for i in places] if threshold else [0]
    else:
        masks = [1 << a | 1 << b for k, a in enumerate(places) for b in places[k + 1 :]]
    for m in masks:
        rest = group & np.uint64(~m & (2**64 - 1))
        order = np.argsort(rest, kind="stable")
        same = np.flatnonzero(rest[order][1:] == rest[order][:-1])
        yield from zip(group[order[same]].tolist(), group[order[same + 1]].tolist())


def links(distinct: DataFrame, threshold: int = 2, rows: int | None = None) -> DataFrame:
    """Edges ``a``, ``b`` (signed longs) that connect what the links of ``fp`` connect.

    ``distinct`` has each fingerprint once, ``rows`` of them at most if that is known. A task returns a spanning forest of the
    links it found, which are as many rows as it has fingerprints at most.
    """

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(fps), 2048):
                part = fps[i : i + 2048]
                at, anchor = anchors(part, threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part[at].view(np.int64))], names=["anchor", "fp"]
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def work(anchor: np.ndarray, fp: np.ndarray) -> None:
            cuts = np.flatnonzero(np.diff(anchor)) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(anchor)]
            size = ends - starts
            # Groups of two, by far the most, are compared all at once.
            pair = starts[size == 2]
            near = pair[np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= threshold]
            found = [zip(fp[near].tolist(), fp[near + 1].tolist())]
            found += [_linked(fp[s:e], threshold) for s, e in zip(starts[size > 2], ends[size > 2])]
            for some in found:
                for x, y in some:
                    rx, ry = _find(parent, x), _find(parent, y)
                    if rx != ry:
                        parent[max(rx, ry)] = min(rx, ry)

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            anchor = b.column(0).to_numpy(zero_copy_only=False)
            fp = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(anchor):
                continue
            held.append((anchor, fp))
            if anchor[0] != anchor[-1] or held[0][0][0] != anchor[-1]:
                anchor, fp = (np.concatenate(x) for x in zip(*held))
                last = int(np.searchsorted(anchor, anchor[-1]))
                work(anchor[:last], fp[:last])
                held = [(anchor[last:], fp[last:])]
        if held:
            work(*(np.concatenate(x) for x in zip(*held)))
        nodes = np.array(list({*parent, *parent.values()}), dtype=np.uint64)
        roots = np.array([_find(parent, int(x)) for x in nodes], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in forest(nodes, roots)], names=["a", "b"])
        release()

    # Parts for what the replicas will be, not for the few fingerprints that they are made of.
    n = distinct.count() if rows is None else rows
    parts = max(distinct.sparkSession.sparkContext.defaultParallelism, -(-n // DEALT))
    dealt = distinct.select("fp").repartition(parts).mapInArrow(replicate, "anchor long, fp long")
    dealt = dealt.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(compare, "a long, b long")


def simhash_components(
    docs: DataFrame,
    threshold: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    more: DataFrame | None = None,
    text_hash: bool = False,
) -> DataFrame:
    """Fingerprint and component of every row.

    Returns the id, ``fingerprint`` (16 lowercase hex digits) and ``component_id``:
    the smallest id that links reach. Null and empty texts and texts without words
    have fingerprint zero and link like any other. Null ids are no component's
    smallest id unless it has no other. Repeated rows stay repeated; an empty table
    gives an empty table; other columns are not read. ``more`` has further links
    (``a`` and ``b``, fingerprints as signed longs), such as those of ``near_copies``.
    ``text_hash`` adds the columns ``th`` of ``fingerprints`` and ``root`` (a fingerprint
    that is the component's own, where several have the same smallest id).
    """
    prints = table(fingerprints(docs, id_col, text_col, text_hash), "simhash-fp")
    smallest = prints.groupBy("fp").agg(F.min("id").alias("least"))
    edges = links(smallest, threshold, prints.count()).where("a <> b")
    edges = edges if more is None else edges.unionByName(more.select("a", "b"))
    roots = connected_components(edges).withColumnRenamed("node", "fp")
    # Only fingerprints with links are in roots; the others are their own component.
    # Cut, so that the next joins can split a large component's or a frequent text's rows.
    least = cut(smallest.join(roots, "fp").groupBy("root").agg(F.min("least").alias("component")))
    found = roots.join(least, "root").select("fp", "root", "component")
    own = F.coalesce("component", "least").alias("component"), F.coalesce("root", "fp").alias("root")
    of = cut(smallest.join(found, "fp", "left").select("fp", *own))
    return prints.join(of, "fp", "left").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
        *(["th", "root"] if text_hash else []),
    )
