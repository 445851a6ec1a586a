"""The operators against brute force, public libraries and hand-made cases."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from tilewright.llm import (
    bit_sliced,
    graph,
    host_reputation,
    piece_bpe,
    sentence_spans,
    sharding,
    simhash,
    site_style,
    spaced_seeds,
    toxicity,
    viterbi,
)
from tilewright.llm.queries import PIECES, URL_RULES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, th string, spans int"
HARD = [None, "", " ", "\n\t", "a", "  a  b ", "▁x y▁", "a▁▁ b", "\0\x01", "é 日本 힣 🙂🙂", "<s> <unk> <0x41></s>", "x" * 5000, "in " * 3000]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns whose names the operators use inside."""
    rows = [(i, t, None, "s", None, "x", None, 1) for i, t in enumerate(HARD)]
    rows += [rows[5], (5, "another text with the same id", None, None, 1, None, "y", None), (None, "no id", None, None, 1, "z", "z", 2)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(rng, n):
    return [rng.choice("abcdefgh") + rng.choice(["lor", "em", "ip", "sum", "dol", "sit"]) + str(rng.randrange(90)) for _ in range(n)]


# op1 ------------------------------------------------------------------------------------------------------------


def test_urls_rules_and_parts(spark):
    urls = [None, "", "no scheme", "http://A.Example.NET/en/x?q#f", "http://example.net/de/", "https://net", "x://b.org/fr/", "x://b.org/fr",
            "http://example.com/de/1", "http://badexample.com/de/1", "a://b://c/d", "http://ÄB.net/", "http://h?/x", "http://u@h.net:80/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r for r in host_reputation.judge_urls(pages, labels, URL_RULES).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
        path = m[2] if m else ""
        fit = [(len(r), r, v) for r, v in URL_RULES if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
        want = max(fit) if fit else (0, None, "allow")
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, want[1], want[2]), u


def test_reputation_shrinks_and_blocks(spark):
    rows, labels = [], []
    for i in range(400):
        kind = "bad" if i < 40 else f"h{i % 9}"
        rows.append((i, f"http://{kind}.site{i % 3 if i >= 40 else 9}.org/"))
        labels.append((i, 0 if kind == "bad" else 1, None))
    rows += [(1000, "http://new.site9.org/"), (1001, "http://other.com/"), (None, "http://other.com/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    label = spark.createDataFrame([*labels, labels[0], (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = {r["host"]: r for r in host_reputation.reputations(pages, label).collect()}
    assert got["bad.site9.org"]["n"] == 40 and got["bad.site9.org"]["bad_bound"] > 0.5
    assert got["bad.site9.org"]["bad_rate"] > got["new.site9.org"]["bad_rate"] > got["other.com"]["bad_rate"] > got["h1.site1.org"]["bad_rate"] >= 0
    judged = {r["page_id"]: r["verdict"] for r in host_reputation.judge_urls(pages, label).collect()}
    assert judged[0] == "block" and judged[100] == judged[1001] == "allow"
    assert host_reputation.judge_urls(pages.limit(0), label).count() == 0
    assert {r["verdict"] for r in host_reputation.judge_urls(pages, label.limit(0)).collect()} == {"allow"}


# op2 ------------------------------------------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.3, 7)]) for i in range(300)]
    vectors += [(300 + i, vectors[3][1]) for i in range(50)]  # ties
    vectors += [(400, None), (420, [0.1, None] + [0.0] * 5), (440, [math.nan] * 7), (460, [math.inf] * 7), (480, [0.5]), (500, [])]
    table = spark.createDataFrame([(i, v, "c", 0) for i, v in vectors], "vec_id long, embedding array<float>, ids string, number int")
    for size in (64, 5000):
        got = bit_sliced.top_inner_products(table, table.where("vec_id % 20 = 0"), 20, 64, rows=size).collect()
        whole = {}
        for i, v in vectors:
            if v is not None and all(x is not None and math.isfinite(x) for x in v):
                q = [math.floor(64 * float(np.float32(x))) for x in v]
                whole[i] = q + [0] * (7 - len(q))
        want = set()
        for q in (i for i in whole if i % 20 == 0):
            best = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)[:20]
            want |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
        assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert bit_sliced.top_inner_products(table.limit(0), table.limit(0)).count() == 0
    # Large components of both signs, up to sums of 63 bits.
    large = [(i, [float(rng.integers(-(2**e), 2**e)) for e in (16, 20, 24)]) for i in range(120)] + [(120, [2.0**24, 0.0, -(2.0**23)])]
    rows = spark.createDataFrame([(i, v) for i, v in large], "vec_id long, embedding array<double>")
    got = {tuple(r) for r in bit_sliced.top_inner_products(rows, rows.where("vec_id % 20 = 0"), 5, 64, rows=50).collect()}
    want = set()
    for q, v in large[::20]:
        best = sorted((-sum(int(64 * a) * int(64 * b) for a, b in zip(v, w)), i) for i, w in large if i != q)[:5]
        want |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    assert got == want and max(abs(s) for *_, s in want) > 2**55
    for huge in ([(0, [2.0**40]), (1, [2.0**40])], [(0, [2.0**60]), (1, [0.0])]):
        with pytest.raises(Exception, match="64-bit integer|beyond 2"):
            rows = spark.createDataFrame(huge, "vec_id long, embedding array<double>")
            bit_sliced.top_inner_products(rows, rows).collect()
    few = bit_sliced.top_inner_products(table.where("vec_id < 3"), table.where("vec_id = 0")).collect()
    assert [(r["rank"], r["query_id"]) for r in few] == [(1, 0), (2, 0)]


# op3 ------------------------------------------------------------------------------------------------------------


def test_feistel_is_a_permutation(spark):
    for n in (1, 2, 3, 24, 97, 1000, 5003):
        got = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 7)).collect()]
        assert sorted(got) == list(range(n))
    assert got != sorted(got)


def test_shards(spark, hard, empty):
    got = sharding.feistel_shards(hard, 5).collect()
    again = sharding.feistel_shards(hard.repartition(3), 5).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    texts = sorted((r["doc_id"] is None, r["doc_id"] or 0, len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in hard.collect())
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == texts
    shards = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in range(5)}
    sizes = [len(v) for v in shards.values()]
    assert max(sizes) - min(sizes) <= 1 and all(v == list(range(len(v))) for v in shards.values())
    assert sharding.feistel_shards(empty).count() == 0


# op4, op7 -------------------------------------------------------------------------------------------------------


def test_viterbi_equals_the_library(spark, docs, hard, empty):
    vocab = viterbi.vocabulary(PIECES)
    lib = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
    lib.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    for table in (docs, hard):
        rows = table.select("doc_id", "text").collect()
        got = sorted(((r[0] is None, r[0] or 0, r[1]) for r in viterbi.token_counts(table, PIECES).collect()))
        want = [len(e.ids) for e in lib.encode_batch([r["text"] or "" for r in rows], add_special_tokens=False)]
        assert got == sorted((r["doc_id"] is None, r["doc_id"] or 0, n) for r, n in zip(rows, want))
    assert viterbi.token_counts(empty, PIECES).count() == 0


@pytest.mark.parametrize("fallback", [True, False])
def test_viterbi_ties_and_unknowns(fallback):
    vocab = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("b", -2.0), ("ab", -3.0), ("▁a", -2.0), ("ba", -2.5), ("é", -9.0)]
    lib = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=fallback))
    lib.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    own = viterbi.UnigramCounter(vocab, 0, fallback)
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice("aab xé ") for _ in range(rng.randrange(12)))
        assert own.count(text)[1] == len(lib.encode(text, add_special_tokens=False).ids), text


def test_bpe_equals_the_library(spark, docs, hard, empty):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for table in (docs, hard):
        rows = table.select("doc_id", "text").collect()
        want = []
        for r in rows:
            ids = lib.encode(r["text"] or "", add_eos=True)
            sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), lib.decode(ids))]
            want.append((str(r["doc_id"]), len(ids), *sha))
        got = piece_bpe.piece_bpe_digests(table, PIECES, check_every=3).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    for r in piece_bpe.piece_bpe_encode(hard.where("doc_id < 12"), PIECES, check_every=1).collect():
        assert r["decoded"] == lib.decode(r["ids"])
    assert piece_bpe.piece_bpe_encode(empty, PIECES).count() == 0


def test_decoded_text_is_made_of_the_ids():
    t = piece_bpe.PieceBpe(PIECES)
    t.piece = np.where(t.piece < 0, t.piece, t.library.piece_to_id("▁the"))  # any piece is this one now
    texts = ["some other words", "a  b", "é 日本 🙂🙂", ""]
    for text, (n, ids, decoded) in zip(texts, t.digests(texts)):
        own = list(map(int, ids.split(" ")))
        assert len(own) == n and decoded == t.library.decode(own)
        assert (decoded == text) == (text == "")


# op5 ------------------------------------------------------------------------------------------------------------


def test_toxicity_held_out(spark, hard, empty):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    scored = toxicity.toxicity(d, labels)
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and 0 <= r["score"] <= 1 for r in rows)
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == k] for k in (1, 0))
    assert np.mean([t > c for t in toxic for c in clean]) > 0.9
    assert np.mean([r["predicted"] for r in rows if not r["toxic"]]) < 0.02
    assert scored.count() == d.count()
    assert toxicity.toxicity(hard, labels).count() == hard.count()
    assert toxicity.toxicity(hard, labels.limit(0)).where("score > 0.001").count() == 0
    assert toxicity.toxicity(empty, labels).count() == 0


def brute_features(text):
    """The hashes of the distinct n-grams, character by character."""
    plain = " " + " ".join((text or "").lower().split()) + " "
    out = set()
    for n in toxicity.GRAMS:
        for i in range(len(plain) - n + 1):
            h = n
            for c in plain[i : i + n]:
                h = (h ^ ord(c)) * 2654435761 % 2**32
                h ^= h >> 15
            out.add(h >> (32 - toxicity.HASH_BITS))
    return out


def test_toxicity_against_brute_force(spark):
    rng = random.Random(5)
    texts = {i: " ".join(words(rng, rng.randrange(12)) + ["vile"] * (i % 5 == 0)) for i in range(90)} | {90: None, 91: ""}
    marks = {i: int(i % 5 == 0) for i in range(0, 90, 2)} | {90: 0, 3: None}
    rows = [(i, t, "en", "s", 1, "x", None, 1) for i, t in texts.items()] + [(4, "the same id again", "en", "s", 1, "x", None, 1)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 1, t) for i, t in marks.items()] + [(6, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    learnt = [(t, marks[i]) for i, t, *_ in rows if marks.get(i) is not None and i != 6 and zlib.crc32(str(i).encode()) % 4 != 2]
    toxic, clean, n_toxic, n_clean = toxicity.feature_counts(toxicity.labelled(docs, labels))
    assert (n_toxic, n_clean) == tuple(sum(y == k for _, y in learnt) for k in (1, 0))
    for got, k in ((toxic, 1), (clean, 0)):
        want = np.zeros(1 << toxicity.HASH_BITS, dtype=int)
        for t, y in learnt:
            if y == k:
                want[sorted(brute_features(t))] += 1
        assert (got == want).all()
    ratio = toxicity.log_count_ratios(toxic, clean, n_toxic, n_clean)
    sure = 0
    for f in set().union(*map(brute_features, texts.values())):
        own = math.log((toxic[f] + 1) / (n_toxic + 2)) - math.log((clean[f] + 1) / (n_clean + 2))
        chance = math.sqrt(1 / (toxic[f] + 1) + 1 / (clean[f] + 1))
        sure += abs(own) >= 2.5 * chance
        assert math.isclose(ratio[f], own if abs(own) >= 2.5 * chance else 0.0)
    assert sure
    # The regression's optimum by Newton's method on a dense matrix; the rounds of a fit approach it.
    x = np.zeros((len(learnt), 1 << toxicity.HASH_BITS))
    for i, (t, _) in enumerate(learnt):
        own = sorted(brute_features(t))
        x[i, own] = ratio[own]
    used = np.flatnonzero(x.any(axis=0))
    x, y = x[:, used], np.array([k for _, k in learnt], dtype=float)
    n, f = len(y), np.zeros(len(y))
    for _ in range(60):
        p = 1 / (1 + np.exp(-f))
        weight = np.maximum(p * (1 - p), 1e-9)
        system = np.block([[x @ x.T + np.diag(toxicity.SHRINK / weight), np.ones((n, 1))], [np.ones((1, n)), np.zeros((1, 1))]])
        *dual, b = np.linalg.solve(system, np.r_[f + (y - p) / weight, 0.0])
        f = x @ x.T @ dual + b
    exact = toxicity.fit(*toxicity.sampled(toxicity.labelled(docs, labels), 6000, ratio), ratio, rounds=4000)
    assert np.allclose(exact.weights[used], x.T @ dual * ratio[used], atol=1e-4) and abs(exact.intercept - b) < 1e-2
    model = toxicity.train(docs, labels)
    for r in toxicity.toxicity(docs, labels).collect():
        if r["doc_id"] != 4:
            z = model.intercept + sum(float(model.weights[k]) for k in brute_features(texts[r["doc_id"]]))
            assert math.isclose(r["score"], 1 / (1 + math.exp(-z)), rel_tol=1e-4)
            assert r["predicted"] == int(r["score"] >= 0.3)
    few, marks = toxicity.sampled(toxicity.labelled(docs, labels), 10, ratio)
    assert len(few) == len(marks) == 10


# op6 ------------------------------------------------------------------------------------------------------------


def test_main_text():
    page = """<html><head><title>t</title><style>p{}</style></head><body><nav><a href=x>menu</a></nav><div class="Ad box">ad</div>
    <article><h1>One &amp; two</h1><p>a <b>b</b>\n c&nbsp;d<br>e<p>f<script>var t="</p>";</script> g<div class=comments>no</div></article>
    <footer>&copy;</footer>"""
    assert site_style.main_text(page, set()) == "One & two\na b c d e\nf g"
    assert site_style.main_text(None, set()) == site_style.main_text("", set()) == site_style.main_text("<nav>x</nav>", set()) == ""
    assert site_style.main_text("<p>a < b <3 <x", set()) == "a < b <3"
    assert site_style.main_text("plain", set()) == "plain"
    assert site_style.main_text("<div>" * 3000 + "deep", set()) == "deep"


def test_style_tree_removes_what_pages_share(spark):
    rows = [(i, f"http://h.org/{i}", f"<body><div class=top><p>Same words on all pages</p></div><div class=x><p>text {i}</p><p>more {i * 7}</p></div></body>") for i in range(30)]
    rows += [(100, None, None), (101, "", ""), (102, "http://one.org/", "<body><div class=top><p>Same words on all pages</p></div></body>")]
    rows += [(200 + i, "http://copy.org/", "<body><p>all the same</p></body>") for i in range(9)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, paths string")
    got = {r["page_id"]: r for r in site_style.site_style_text(pages).collect()}
    assert len(got) == len(rows)
    assert got[3]["text"] == "text 3\nmore 21" and got[3]["n_chars"] == 14
    assert got[100]["text"] == got[101]["text"] == "" and got[102]["text"] == "Same words on all pages"
    assert got[200]["text"] == "all the same"
    assert site_style.site_style_text(pages.limit(0)).count() == 0


# op8 ------------------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not w:
        return 0
    sh = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i in range(len(fps)):
        known = [ids[j] for j in range(len(fps)) if find(j) == find(i) and ids[j] is not None]
        least[i] = min(known) if known else None
    return least


def test_anchors_meet_within_the_threshold():
    rng = np.random.default_rng(5)
    f = rng.integers(0, 2**64, 300, dtype=np.uint64)
    g = f.copy()
    for _ in range(2):
        g ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    of = [{}, {}]
    for k, x in enumerate((f, g)):
        at, anchor = simhash.anchors(x)
        for i, a in zip(at.tolist(), anchor.tolist()):
            of[k].setdefault(i, set()).add(a)
    assert all(of[0][i] & of[1][i] for i in range(300))
    at, anchor = simhash.anchors(f, 0)
    assert len(at) == 300  # each word has one home: the code is perfect


def test_simhash_components(spark, docs, hard, empty):
    for table in (docs, hard):
        rows = [(r["doc_id"], r["text"]) for r in table.collect()]
        fps = [brute_fingerprint(t) for _, t in rows]
        least = brute_components(fps, [i for i, _ in rows])
        want = sorted((str(rows[i][0]), f"{fps[i]:016x}", str(least[i])) for i in range(len(rows)))
        got = sorted((str(r[0]), r[1], str(r[2])) for r in simhash.simhash_components(table).collect())
        assert got == want
    assert simhash.simhash_components(empty).count() == 0


def test_simhash_chains_and_large_groups(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = int(rng.integers(0, 2**63))
    chain = [base]
    for i in range(0, 60, 2):
        chain.append(chain[-1] ^ (3 << i))
    fps = np.array([*chain, *rng.integers(0, 2**63, 50).tolist()], dtype=np.uint64)
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    edges = simhash.links(table).where("a <> b")
    roots = {r["node"]: r["root"] for r in graph.connected_components(edges).collect()}
    assert set(roots) == {int(np.uint64(x).astype(np.int64)) for x in chain} and len(set(roots.values())) == 1
    group = np.unique(np.uint64(base) ^ (np.uint64(1) << rng.integers(0, 12, 200).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 12, 200).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 30, 200).astype(np.uint64)))
    plain = set(map(frozenset, components(simhash._linked(group, 2))))
    monkeypatch.setattr(simhash, "BRUTE", 4)
    assert set(map(frozenset, components(simhash._linked(group, 2)))) == plain


def components(edges):
    groups = {}
    for a, b in edges:
        one = groups.get(a, {a}) | groups.get(b, {b})
        for x in one:
            groups[x] = one
    return groups.values()


# op9 ------------------------------------------------------------------------------------------------------------


def brute_removed(rows):
    """Texts without repeats, from the definition: every run is compared with all runs before it."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, xx(rows[i][1])))
    first, out = {}, {}
    for i in order:
        parts = sentence_spans.sentences(rows[i][1] or "")
        kept = [k for k, p in enumerate(parts) if p.strip()]
        size = [parts[k].strip().count(" ") + 1 for k in kept]
        gone = set()
        for a in range(len(kept)):
            b = a + 1 if size[a] >= sentence_spans.LONG_WORDS else a + 2
            if size[a] < sentence_spans.LONG_WORDS:
                while b <= len(kept) and sum(size[a:b]) < sentence_spans.MIN_WORDS:
                    b += 1
            if b > len(kept):
                continue
            key = tuple(parts[k].strip() for k in kept[a:b])
            if first.setdefault(key, (rows[i], kept[a])) != (rows[i], kept[a]):
                gone.update(range(kept[a], kept[b - 1] + 1))
        out[i] = (None if rows[i][1] is None else "".join(p for k, p in enumerate(parts) if k not in gone), len(gone))
    return out


def xx(text):
    return int(np.uint64(xxhash.xxh64_intdigest((text or "").encode(), 42)).astype(np.int64))


def test_substring_dedup(spark, docs, hard, empty):
    rng = random.Random(4)
    shared = " ".join(" ".join(words(rng, 9)) + "." for _ in range(7))
    own = [[" ".join(words(rng, 9)) + "." for _ in range(12)] for _ in range(6)]
    texts = [" ".join([*o[:6], "and " + shared, *o[6:]]) for o in own[:4]] + [" ".join(o) for o in own[4:]]
    made = spark.createDataFrame([(i, t, None, "s", 1, "x", None, 1) for i, t in enumerate(texts)], DOCS)
    for table in (made, docs, hard):
        rows = [(r["doc_id"], r["text"]) for r in table.collect()]
        want = brute_removed(rows)
        got = sentence_spans.substring_dedup(table)
        assert set(table.columns) < set(got.columns)
        found = sorted((str(r["doc_id"]), str(r["text"]), r["n_removed"]) for r in got.collect())
        assert found == sorted((str(rows[i][0]), str(want[i][0]), want[i][1]) for i in range(len(rows)))
    clean = {r["doc_id"]: r["text"] for r in sentence_spans.substring_dedup(made).collect()}
    assert [clean[i] == t for i, t in enumerate(texts)] == [True, False, False, False, True, True]
    assert len(set(shared.split()) & set(clean[2].split())) < 15
    assert sentence_spans.substring_dedup(empty).count() == 0


# op10 -----------------------------------------------------------------------------------------------------------


def brute_overlap(a, b):
    best = 0
    for shift in range(-len(a), len(b)):
        lo, hi = max(0, -shift), min(len(a), len(b) - shift)
        for i in range(lo, hi):
            for j in range(hi, i, -1):
                if j - i < min(spaced_seeds.MIN_TOKENS, len(b)) or j - i <= best:
                    break
                if sum(a[k] == b[k + shift] for k in range(i, j)) >= spaced_seeds.MIN_SHARE * (j - i):
                    best = j - i
    return best


def test_overlap_equals_brute_force():
    rng = random.Random(6)
    for _ in range(60):
        b = [rng.randrange(4) for _ in range(rng.randrange(1, 25))]
        a = [rng.randrange(4) for _ in range(rng.randrange(0, 30))]
        own = max((spaced_seeds.overlap(np.array(a), np.array(b), s, spaced_seeds.MIN_TOKENS, spaced_seeds.MIN_SHARE) for s in range(-len(a), len(b))), default=0)
        assert own == brute_overlap(a, b)


def test_decontamination(spark, hard, empty):
    rng = random.Random(7)
    items = [words(rng, n) for n in (15, 25, 60, 9, 5)]
    item = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(9, None), (10, "")], "item_id long, text string")
    rows, want = [], {}
    for i in range(60):
        text, target = words(rng, 120), None
        if i % 3 == 0:
            target = i % 4
            leak = list(items[target])
            for k in rng.sample(range(1, len(leak) - 1), len(leak) // 12):
                leak[k] = "other"
            text[50:50] = [w.upper() + "," for w in leak]
        rows.append((i, " ".join(text), "en", "s", 1, "x", None, 1))
        want[i] = target
    table = spark.createDataFrame(rows, DOCS)
    got = {r["doc_id"]: r for r in spaced_seeds.contamination(table, item).collect()}
    assert {i: (r["item_ids"] or [None])[0] for i, r in got.items()} == want
    assert all(r["contaminated"] == (want[i] is not None) for i, r in got.items())
    kept = spaced_seeds.decontaminate(table, item)
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in want if want[i] is None] and kept.columns == table.columns
    for x in (item, item.limit(0)):
        assert spaced_seeds.contamination(hard, x).count() == spaced_seeds.decontaminate(hard, x).count() == hard.count()
    assert spaced_seeds.contamination(empty, item).count() == spaced_seeds.decontaminate(empty, item).count() == 0


def test_seeds_survive_a_substitution():
    rng = random.Random(8)
    w = words(rng, 30)
    for k in range(30):
        other = [*w[:k], "changed", *w[k + 1 :]]
        a, b = (spaced_seeds.seeds(spaced_seeds.token_hashes(" ".join(x))) for x in (w, other))
        assert any(np.any(x == y) for (x, _), (y, _) in zip(a, b))
