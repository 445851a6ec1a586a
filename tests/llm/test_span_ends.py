"""The substring dedup stage removes repeated spans to their ends."""

import random

import corpus_pipeline
import duckdb
import pyarrow as pa

from tests.llm.test_operators import DOCS, words
from tilewright.llm import oracles, sentence_spans


def spans(rng, sizes):
    return [" ".join(words(rng, n)) + "." for n in sizes]


def brute_runs(sizes):
    """Every run of two sentences and 15 words or of one with 25 that no shorter run starts or ends as."""
    found = set()
    for a in range(len(sizes)):
        for b in range(a + 1, len(sizes) + 1):
            enough = sizes[a] >= 25 if b == a + 1 else sum(sizes[a:b]) >= 15
            if enough:
                found.add((a, b))
    least = {min((a, b) for a, b in found if a == x) for x in {a for a, _ in found}}
    return least | {max((a, b) for a, b in found if b == x) for x in {b for _, b in found}}


def test_runs_of_both_ends_equal_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        sizes = [rng.choice([1, 2, 5, 7, 14, 15, 24, 25, 30]) for _ in range(rng.randrange(9))]
        first, end, _ = sentence_spans.runs(" ".join(spans(rng, sizes)), both_ends=True)
        assert set(zip(first.tolist(), end.tolist())) == brute_runs(sizes) and len(first) == len(brute_runs(sizes))


def test_stage_leaves_no_end_of_a_repeated_span(spark):
    rng = random.Random(2)
    whole = spans(rng, (9, 9, 4, 5))  # the last ones are fewer than 15 words
    inner = spans(rng, (12, 8, 3, 3))
    rows = [" ".join(whole), " ".join(whole), " ".join([*spans(rng, (9, 9)), *inner, *spans(rng, (8, 9))])]
    rows.append(" ".join([own := spans(rng, (9,))[0], *inner, *spans(rng, (7, 9))]))
    docs = spark.createDataFrame([(i, t, None, "s", 1, "x", None, 1) for i, t in enumerate(rows)], DOCS)
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeats(spark, docs, "").collect()}
    assert got[0] == rows[0] and got[2] == rows[2] and 1 not in got
    assert got[3].startswith(own) and not set(" ".join(inner).split()) & set(got[3].split())


def test_stage_removes_passages_planted_in_mid_sentence(spark):
    rng = random.Random(3)
    rows = []
    for i in range(40):
        passage = " ".join(words(rng, 56))  # no mark at all, in the middle of a sentence
        for _ in range(2):
            a, b = (" ".join(words(rng, 30)) for _ in range(2))
            rows.append(f"{a} {passage} {b}.")
    docs = spark.createDataFrame([(i, t, None, "s", 1, "x", None, 1) for i, t in enumerate(rows)], DOCS)
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeats(spark, docs, "").collect()}
    assert all(got[i] == rows[i] for i in range(0, 80, 2))
    lost = [len(rows[i].split()) - len(got[i].split()) for i in range(1, 80, 2)]
    assert sum(n >= 15 for n in lost) >= 38 and max(lost) <= 56


def test_scripts_without_blanks_have_words(spark):
    rng = random.Random(4)

    def han(n):
        return "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(n)) + "。"

    shared = han(12) + han(9)
    rows = [han(20) + shared + han(11), han(8) + shared + han(30), han(40)]
    docs = spark.createDataFrame([(i, t, None, "s", 1, "x", None, 1) for i, t in enumerate(rows)], DOCS)
    got = {r["doc_id"]: r["text"] for r in sentence_spans.substring_dedup(docs).collect()}
    assert got[0] == rows[0] and got[2] == rows[2] and got[1] == rows[1].replace(shared, "")
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": range(3), "text": rows}))
    assert dict((i, t) for i, t, _ in con.sql(oracles.sentence_spans_sql()).fetchall()) == got


def test_pieces_make_up_the_text():
    for text in ["", " ", "a, b;c\n\nd. e", "é日本。語 x, ", "  lead " + "w x " * 60]:
        assert "".join(sentence_spans.pieces(text)) == text
