"""Every overlap that decontamination promises has a seed: enumerated, and in whole runs."""

import itertools
import random
import re
import time

import numpy as np
import pytest

from tests.llm.test_operators import DOCS, words
from tilewright.llm import spaced_seeds


@pytest.mark.parametrize("n", range(spaced_seeds.MIN_ITEM, 26))
def test_masks_hit_every_pattern(n):
    # 26 tokens and more are two overlaps of 13 or more, of which one has no larger share of substitutions.
    left = np.array([sum(1 << i for i in c) for c in itertools.combinations(range(n), n // 5)])
    for mask in spaced_seeds.MASKS:
        bits = sum(1 << i for i, c in enumerate(mask) if c == "#")
        for place in range(n - len(mask) + 1):
            left = left[left & (bits << place) != 0]
    assert not len(left)


def test_substituted_items_are_found(spark):
    rng = random.Random(11)
    items = [words(rng, n) for n in (8, 9, 10, 11, 12, 13, 15, 15, 16, 18, 20, 23, 40, 7)]
    item = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    rows = []
    for i in range(140):
        leak = list(items[i % 14])
        for k in rng.sample(range(len(leak)), len(leak) // 5 if i % 14 < 13 else 0):
            leak[k] = "other"
        text = words(rng, 60)
        text[30:30] = leak
        rows.append((i, " ".join(text), "en", "s", 1, "x", None, 1))
    got = {r["doc_id"]: r for r in spaced_seeds.contamination(spark.createDataFrame(rows, DOCS), item).collect()}
    for i in range(140):
        assert got[i]["item_ids"] == [i % 14], i


def brute_overlap(a, b):
    """The longest run of aligned tokens that counts as an overlap, every start and end tried."""
    need, share = min(spaced_seeds.MIN_TOKENS, len(b)), 0.8 if len(b) >= spaced_seeds.MIN_ITEM else 1.0
    best = 0
    for shift in range(-len(a) + 1, len(b)):
        lo, hi = max(0, -shift), min(len(a), len(b) - shift)
        for i in range(lo, hi):
            same = 0
            for j in range(i, hi):
                same += a[j] == b[j + shift]
                if j - i + 1 >= need and 10 * same >= 10 * share * (j - i + 1):
                    best = max(best, j - i + 1)
    return best


def plain_tokens(text):
    """Tokens by a regular expression alone."""
    return re.findall(r"[\u4e00-\u9fff]|[^\W\u4e00-\u9fff]+", (text or "").lower())


def test_whole_answer_against_brute_force(spark):
    """Substituted, short, repetitive and Chinese items, equal texts, repeated seeds and clean texts."""
    rng = random.Random(12)
    han = "".join(chr(0x4E00 + rng.randrange(900)) for _ in range(40))
    items = [" ".join(words(rng, n)) for n in (30, 16, 13, 9, 8, 5, 3)] + [han, "la " * 20, "", None, han]
    texts = [" ".join(words(rng, 60)) for _ in range(12)] + [None, "", "la " * 70, "x" * 9000, han[:20], han[3:30] + "。" + han[:9]]
    for i in range(48):
        leak = (items[i % 9] or "").split()
        for k in rng.sample(range(len(leak)), rng.randrange(len(leak) // 4 + 1)):
            leak[k] = "other"
        text = words(rng, 25)
        text[rng.randrange(25) : 0] = leak
        texts += [" ".join(text)] * rng.randrange(1, 3)
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", None, 1) for i, t in enumerate(texts)], DOCS)
    item = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r["doc_id"]: r for r in spaced_seeds.contamination(docs, item).collect()}
    found = 0
    for i, t in enumerate(texts):
        own = {k: brute_overlap(plain_tokens(t), plain_tokens(x)) for k, x in enumerate(items)}
        assert got[i]["item_ids"] == [k for k, n in own.items() if n], i
        assert got[i]["overlap_tokens"] == max(own.values()), i
        found += any(own.values())
    assert 30 < found < len(texts) - 8
    kept = {r["doc_id"] for r in spaced_seeds.decontaminate(docs, item).collect()}
    assert kept == {i for i, r in got.items() if not r["contaminated"]}


def test_repetitive_texts_end_soon():
    began = time.perf_counter()
    a, b = (spaced_seeds.token_hashes("no way " * n) for n in (100_000, 1_500))
    assert spaced_seeds.longest_overlap(a, b, 13, 0.8) == len(b)
    assert time.perf_counter() - began < 60
