"""Periodic runs, centroid clusters and page wrappers against brute force and hand-made pages."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from gaugeflow.llm import clusters, periodic_runs, queries, wrappers
from gaugeflow.llm.markup import blocks_of, outline_of
from gaugeflow.llm.ship import ship_package

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def session(spark):
    ship_package(spark)
    return spark


# --- periodic runs --------------------------------------------------------------------------------


def brute_runs(words, least=24, times=3):
    """Every longest stretch in which words q apart are equal, for every q, with no smaller period."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    a = np.array([numbers[w] for w in words], int)
    found = []
    for q in range(1, len(a) // times + 1):
        equal = np.concatenate([[False], a[q:] == a[:-q], [False]]).astype(int)
        starts, stops = np.flatnonzero(np.diff(equal) == 1), np.flatnonzero(np.diff(equal) == -1) + q
        for start, stop in zip(starts, stops, strict=True):
            part = a[start:stop]
            if len(part) < max(least, times * q):
                continue
            if not any((part[d:] == part[:-d]).all() for d in range(1, q)):
                found.append((int(start), int(stop - start), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def odd_texts():
    rng = random.Random(3)
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", "a " * 24, "a " * 23, " x y " * 30, " lead  trail "]
    for size in (1, 2, 3):
        texts += [" ".join(rng.choice("abc"[:size]) for _ in range(rng.randint(1, 90))) for _ in range(25)]
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            unit = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 17))]
            whole = unit * rng.randint(1, 9)
            parts += whole[: rng.randint(1, len(whole))]
        texts.append("  ".join(parts))
    return texts


def test_runs_equal_brute_force(session):
    texts = odd_texts()
    rows = [(i, t, "clash", [1]) for i, t in enumerate(texts)] + [(4, texts[4], "twice", None), (None, texts[4], "", None)]
    docs = session.createDataFrame(rows, "doc_id long, text string, collapsed string, runs array<int>")
    found = periodic_runs.periodic_runs(docs)
    got = {(r.doc_id, r.collapsed): r for r in found.collect()}
    assert found.count() == len(rows)
    some = 0
    for i, text in enumerate(texts):
        words = [w.decode() for w in (text or "").encode().split()]
        want = brute_runs(words)
        some += len(want) > 1
        r = got[i, collapsed(words, want)]
        assert [tuple(x) for x in r.runs] == want
        assert (r.n_words, r.n_kept) == (len(words), len(r.collapsed.split(" ")) if r.collapsed else 0)
    assert some > 2


def test_texts_do_not_mix_and_slices_do_not_matter(session, monkeypatch):
    docs = session.createDataFrame([(i, "x y " * 8) for i in range(50)], "doc_id long, text string").coalesce(1)
    assert {len(r.runs) for r in periodic_runs.periodic_runs(docs).collect()} == {0}
    rng = random.Random(5)
    words = np.array([rng.randrange(3) for _ in range(4000)])
    sizes = np.array([0, 1000, 0, 2500, 500, 0])
    got = list(zip(*(x.tolist() for x in periodic_runs.runs(words, sizes, 8, 2)), strict=True))
    want = []
    for at, size in ((0, 1000), (1000, 2500), (3500, 500)):
        want += [(at + s, n, q) for s, n, q in brute_runs(words[at : at + size].tolist(), 8, 3)]
    assert [r for r in got if r[1] >= 3 * r[2]] == want


def test_a_long_period(session):
    words = [f"w{i}" for i in range(7001)] * 3 + ["end"]
    docs = session.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    (row,) = periodic_runs.periodic_runs(docs).collect()
    assert [tuple(r) for r in row.runs] == [(0, 21003, 7001)]


def test_run_query_equals_brute_force(session):
    docs = session.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op13_periodic_runs"](session, SF).collect()}
    assert len(got) == len(docs)
    planted = 0
    for doc in docs:
        words = [w.decode() for w in (doc.text or "").encode().split()]
        h, n = zlib.crc32(str(doc.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want, r = brute_runs(words), got[doc.doc_id]
        planted += h % 10 == 0 and bool(want)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in want)
        assert r.n_runs == len(want)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, want).encode()).hexdigest()
        best = min(want, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (best[1] * 1000 // best[2] if best else None)
    assert planted > 3


def test_no_documents(session):
    empty = session.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.digests(periodic_runs.periodic_runs(empty)).count() == 0


# --- clusters -------------------------------------------------------------------------------------


def brute_clusters(rows, k, rounds, seed, dims, scale):
    kept = [
        (i, [int(np.floor(np.float64(v) * scale)) for v in x])
        for i, x in rows
        if x is not None and len(x) == dims and all(v is not None and np.isfinite(v) for v in x)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [x for _, x in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, x in kept:
            members[nearest(x)[1]].append(x)
        centroids = [
            [sum(column) // len(m) for column in zip(*m, strict=True)] if m else c
            for m, c in zip(members, centroids, strict=True)
        ]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    total = sum(d for *_, d in found)
    return sorted(
        (
            str(i), c, d, sum(e for _, b, e in found if b == c), total,
            hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest(),
        )
        for i, c, d in found
    )


def test_clusters_equal_brute_force(session):
    rng = random.Random(1)
    rows = [(i, [rng.choice((-1.5, 0.0, 0.25, 2.0)) for _ in range(4)]) for i in range(120)]
    rows += [(7, rows[7][1])] * 30 + [(None, rows[3][1]), (None, [9.0, 0.001, -0.001, 1e-30])]
    bad = [(200, None), (201, [1.0]), (202, [1.0, None, 2.0, 3.0]), (203, [1.0, float("nan"), 2.0, 3.0])]
    bad += [(204, [float("inf"), 1.0, 1.0, 1.0]), (205, []), (206, [1.0] * 5)]
    schema = "vec_id long, embedding array<double>, cluster string, x int"
    vectors = session.createDataFrame([(*r, "clash", 1) for r in rows + bad], schema).repartition(5)
    for k in (1, 7, 500):
        got = clusters.clusters(vectors, k, 3, "2", dims=4).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == brute_clusters(rows + bad, k, 3, "2", 4, 256)


def test_no_vectors_and_huge_components(session):
    schema = "vec_id long, embedding array<double>"
    assert clusters.clusters(session.createDataFrame([], schema)).count() == 0
    assert clusters.clusters(session.createDataFrame([(1, [1.0])], schema)).count() == 0
    huge = session.createDataFrame([(1, [1e308] * 64), (2, [-1e308] * 64), (3, [0.0] * 64)], schema)
    got = {r.vec_id: r for r in clusters.clusters(huge, 3, 1).collect()}
    assert {r.distance for r in got.values()} == {0} and len({r.cluster for r in got.values()}) == 3


def test_ties_go_to_the_smaller_number():
    centroids = np.array([[0, 0], [4, 0], [0, 0], [2, 2]], np.int64)
    x = np.array([[2, 0], [0, 0], [4, 0], [2, 2], [1, 1]], np.int64)
    assert clusters.nearest(x, *clusters.bisectors(centroids)).tolist() == [0, 0, 1, 3, 0]


# --- pages ----------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, text string, host string"


def texts(session, pages):
    df = session.createDataFrame([(*p, "clash", "clash") for p in pages], PAGES)
    found = wrappers.main_text(df)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    return {r.page_id: r.text for r in rows}


def layout(i, story, extra=""):
    return f"""<!doctype html><HTML><head><title>T {i}</title><style>p{{}}</style><script>var a="<p>x</p>";</script></head>
    <body><header><h1>The Daily</h1></header><div><ul><li><a href=/a>Home {i}</a><li><a href="/b">World</a></ul></div>
    <div>Today it rains.</div><div id="c1"><h2>Story {i}</h2>{story}<p>Read our terms of use.</p>{extra}</div>
    <div class="comments"><p>I like no. {i}</p></div><form><p>Send</p></form><footer>&copy; {i}</footer></body></html>"""


def test_constant_nodes_go_and_slots_stay(session):
    pages = [
        (i, f"http://www.news.example/{i}?x#y", layout(i, f"<p>Words of {i} &amp;\n <b>bo</b>ld<br>new <p>More {i * 7}"))
        for i in range(12)
    ]
    got = texts(session, pages)
    for i in range(12):
        assert got[i] == f"Story {i} Words of {i} & bold new More {i * 7}"


def test_an_article_of_a_host_with_one_page(session):
    html = "<nav><p>x</nav><main><h1>A</h1><p>b <i>c</i> &lt;d&gt; a < b</p><aside>no</aside><div class='ad-box'>buy</div></main><p>no"
    got = texts(session, [(1, "https://one.example/", html), (2, None, html), (3, "no url", html)])
    assert set(got.values()) == {"A b c <d> a < b"}


def test_names_of_parts_and_of_what_is_beside_them(session):
    html = """<body class="has-sidebar comment-page"><div class="page-header">Site</div><div class="with-menu nav-open">
      <article class="post comment-status-open"><header><h1>Title</h1></header><p>Text.</p>
      <section id="comments"><article class="comment"><p>Nice!</p></article></section></article></div>
      <aside>side</aside><div class="cookie-notice">We use cookies</div><div id="sponsored-1">buy</div></body>"""
    plain = "<body><div class='no-sidebar'><div id=story><h2>One</h2>Two<p>Three</div></div><div class=sidebar>x</div>"
    got = texts(session, [(1, "http://names.example/", html), (2, "http://plain.example/", plain)])
    assert got == {1: "Title Text.", 2: "One Two Three"}


def test_copies_make_nothing_constant(session):
    page = "<body><article><h1>Same</h1><p>All of it.</p></article><footer>f</footer>"
    got = texts(session, [(i, "http://copy.example/", page) for i in range(40)])
    assert set(got.values()) == {"Same All of it."}


def test_odd_pages(session):
    odd = [None, "", "plain words", "<", "<p", "</p></div>text", "<p>a<!-- never closed <p>b", "&#xD800;&bogus; &nbsp;x"]
    odd += ["<div>" * 3000 + "deep" + "</div>" * 3000, "<p>" + "long " * 200_000, "<title>only</title>", "<a \"<p 'b>c"]
    pages = [(i, f"http://odd{i}.example/", t) for i, t in enumerate(odd)]
    got = texts(session, pages + [(100, None, None), (100, None, None)])
    assert got[0] == got[1] == got[100] == got[10] == ""
    assert got[2] == "plain words" and got[5] == "text" and got[6] == "a"
    assert got[8] == "deep" and len(got[9]) == 5 * 200_000 - 1
    assert session.createDataFrame([], PAGES).transform(wrappers.main_text).count() == 0


def test_every_article_of_the_test_pages(session):
    """Its pages hold their text in one ``article``; what lies in it is told apart by a plain pattern."""
    import html
    import re

    pages = session.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r.text for r in queries.QUERIES["op12_wrapper_text"](session, SF).collect()}
    assert len(got) == len(pages)
    for page in pages:
        inside = re.search(r"<article>(.*?)</article>", page.html, re.DOTALL)[1]
        inside = re.sub(r"</?b>", "", re.sub(r"<br>|</?p>|</?h1>", " ", inside))
        assert got[page.page_id] == " ".join(html.unescape(inside).split())


def test_outlines_read_back():
    root, found = blocks_of("<div class='a b1' id=x(2)><p>1<p>2<ul><li>3<li>4</ul></div><div>5</div>")
    assert outline_of(root.text()) == root
    assert [b.text for b in found] == ["1", "2", "3", "4", "5"]
    assert found[0].node == found[1].node and found[2].node == found[3].node
