"""What the style tree decides, and text that names or article elements alone would lose."""

import math
import random
import time

import pandas as pd

from tilewright.llm import site_style
from tilewright.llm.site_style import main_text, node_features

TEXT = " ".join(["what the page is about"] * 12)


def test_text_beside_articles_stays():
    page = f"<body><div class=story><p>{TEXT}</p></div><article>teaser one</article><article>teaser two</article></body>"
    assert main_text(page, set()) == f"{TEXT}\nteaser one\nteaser two"
    page = f"<body><p>outside</p><article><p>{TEXT}</p></article></body>"
    assert main_text(page, set()) == TEXT


def test_names_are_a_prior_only():
    for start in ('<body class="no-sidebar">', '<body class="sidebar">', '<body><div class="elementor-widget">', '<body><div id="widget">',
                  "<body><form id=aspnetForm>", '<html class="cookie"><body>'):
        page = f'{start}<div class="menu">home</div><p>{TEXT}</p><div class="ad box">buy</div><nav>more</nav>'
        assert main_text(page, set()) == TEXT, start
    assert main_text(f"<nav>{TEXT}</nav><p>a</p>", set()) == "a"
    assert main_text(f"<article><div class=ad>x y</div>{TEXT}</article>", set()) == TEXT


def test_ordinary_pages_keep_their_story():
    for start, end in (('<body class="single has-sidebar">', ""), ('<body><form id="aspnetForm">', "</form>"), ("<body>", ""),
                       ('<body><article class="post comments-open">', "</article>"), ('<body><div class="ads-free content">', "</div>"),
                       ("<body><header><main>", "</main></header>"), ("<body><article><header><h2>", "</h2></header></article>")):
        assert main_text(f"{start}<p>{TEXT}</p>{end}<nav>menu</nav>", set()) == TEXT, start
    page = f"<body><article>teaser</article><div class=story><p>{TEXT}</p></div></body>"
    assert main_text(page, set()) == f"teaser\n{TEXT}"


def test_tags_that_never_match_end_soon():
    began = time.perf_counter()
    assert main_text("<b>" * 20_000 + "</i>" * 20_000 + "<p>x" * 5_000, set()).startswith("x\nx")
    assert time.perf_counter() - began < 20


def made_sites(spark, hosts=12):
    """Hosts whose menus, notices and adverts have no telling names; the truth is what only one page has."""
    rng = random.Random(9)

    def words(n):
        return " ".join(rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(n))

    rows, truth = [], {}
    for host in range(hosts):
        shared, pool = [words(6) for _ in range(4)], [words(8) for _ in range(2)]
        for page in range(1 if host == 0 else rng.randrange(8, 25)):
            story = [words(rng.randrange(5, 30)) for _ in range(rng.randrange(2, 6))]
            around = f"<div class=a1><a href=/x>{shared[0]}</a> <a href=/y>{shared[1]}</a></div><div class=b2>{rng.choice(pool)}</div>"
            if host == 11:
                story = ["the same story on every page " * 9]
            body = "".join(f"<p>{t}</p>" for t in story)
            html = f"<html><body>{around}<div class=c3><h1>{story[0][:9]}</h1>{body}</div><div class=d4>{shared[2]}<p>{shared[3]}</p></div></body></html>"
            rows.append((len(rows), f"https://h{host}.org/{page}", html))
            truth[len(rows) - 1] = (host, "\n".join([story[0][:9].strip(), *[t.strip() for t in story]]), pool)
    return spark.createDataFrame(rows, "page_id long, url string, html string"), rows, truth


def test_the_tree_decides(spark):
    pages, rows, truth = made_sites(spark)
    got = {r["page_id"]: r["text"] for r in site_style.site_style_text(pages).collect()}
    changed, right = set(), 0
    for i, _, html in rows:
        host, story, pool = truth[i]
        if main_text(html, set()) != got[i]:
            changed.add(host)
        if host in (0, 11):  # one page; copies of each other
            assert main_text(html, set()) == got[i]
        else:  # what all pages share is gone; one of two adverts may stay where pages are few
            assert "\n".join(t for t in got[i].split("\n") if t not in pool) == story
            right += got[i] == story
    assert changed == set(range(1, 11)) and right


def test_importances_against_brute_force(spark):
    """Entropies of every node's features, counted page by page."""
    _, rows, truth = made_sites(spark, 3)
    for host in (1, 2):
        own = [node_features(h) for i, _, h in rows if truth[i][0] == host]
        paths = {k[0] for f in own for k in f}
        above = {k[0]: k[1] for f in own for k in f}

        def leaf(path):
            m = sum(any(k[0] == path for k in f) for f in own)
            out = []
            for kind in (0, 1):
                counts = {}
                for f in own:
                    for k in f:
                        if k[0] == path and k[2] == kind:
                            counts[k[3]] = counts.get(k[3], 0) + 1
                out.append(list(counts.values()))
            chars, text = (sum(f[k][j] for f in own for k in f if k[0] == path and k[2] == 0) for j in (0, 1))
            return m, *out, chars, text

        def importance(path):
            m, looks, contents, chars, text = leaf(path)
            style = -sum(n / m * math.log(n / m, m) for n in looks)
            content = 1 - sum(math.log(n, m) for n in contents) / len(contents) if contents else None
            below = [p for p in paths if p != path and above[p] == path]
            parts = ([(content, text + 1)] if contents else []) + [(importance(p), leaf(p)[3] + 1) for p in below]
            mean = sum(i * w for i, w in parts) / sum(w for _, w in parts) if parts else 0.0
            return max(mean, site_style.DAMP * style + (1 - site_style.DAMP) * mean)

        table = []
        for p in paths:
            m, looks, contents, chars, text = leaf(p)
            sums = sum(n * math.log(n) for n in looks), sum(map(math.log, contents)), len(contents) or None
            table.append((p, above[p], m, chars, text, *sums))
        frame = pd.DataFrame(table, columns=["path", "above", "m", "chars", "own", "style", "content", "contents"])
        records = {r.path: r for r in frame.itertuples()}
        below = {}
        for r in records.values():
            if r.path:
                below.setdefault(r.above, []).append(r.path)
        for p, value in site_style.importances(records, below).items():
            assert math.isclose(value, importance(p), abs_tol=1e-9)
