"""Decontamination, packing and page texts."""

import random
import time
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import text
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, html_extract, packing

ITEMS = [(k, text(5000 + k, n)) for k, n in enumerate([3, 5, 6, 9, 14, 25, 40, 70, 150, 600])]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([*ITEMS, (90, None), (91, ""), (92, " \n")], "item_id long, text string")


def test_windows_fit_into_their_items():
    for n in range(1, 2000):
        length, stride = decontaminate.window_of(n)
        assert length + stride - 1 <= n and 1 <= length <= decontaminate.LONGEST


def test_all_fingerprints_within_the_radius_are_found():
    draw = np.random.default_rng(1)
    size = decontaminate._Size(8, 2, [draw.integers(0, 1 << 63, 50, np.uint64)], [0])
    size.close()
    prints = np.repeat(size.all, 30)
    for k in range(len(prints)):
        for bit in draw.choice(64, draw.integers(0, 16), replace=False):
            prints[k] ^= np.uint64(1) << np.uint64(bit)
    expected = {(i, j) for i, p in enumerate(prints) for j, q in enumerate(size.all) if int(p ^ q).bit_count() <= decontaminate.RADIUS}
    assert set(zip(*(x.tolist() for x in size.found(prints)), strict=True)) == expected and len(expected) > 500


@pytest.mark.parametrize("before", [0, 1, 7, 50, 333])
def test_passages_are_found_wherever_they_begin(before):
    index = decontaminate.Index([t for _, t in ITEMS])
    texts = [f"{text(1, before)} {t.upper()}\n{text(2, 80)}" for _, t in ITEMS]
    found = index.matches(pa.array(texts))
    assert {(k, k) for k in range(1, len(ITEMS))} <= set(found)  # an item of less than a shingle only matches as a whole text
    assert all(found[k, k] == (1.0, before) for k in range(1, len(ITEMS)))
    assert set(index.matches(pa.array([ITEMS[0][1], "clean text of no item at all", None, ""]))) == {(0, 0)}


def test_edited_passages_by_similarity():
    index = decontaminate.Index([t for _, t in ITEMS])
    words = ITEMS[8][1].split()
    one, many = list(words), list(words)
    one[70] = "edited"
    for k in range(0, 150, 7):
        many[k] = f"edited{k}"
    found = index.matches(pa.array([" ".join([text(1, 30), *w, text(2, 30)]) for w in (one, many)]))
    assert set(found) == {(0, 8)} and found[0, 8][0] == pytest.approx((146 - 5) / (146 + 5))


def brute_best(item: str, doc: str) -> float:
    """Weighted Jaccard similarity of the best of all windows of the item's length, one by one."""
    cut = lambda t: [tuple(w[k : k + 5]) for w in [t.lower().split()] for k in range(max(len(w) - 4, 1))]
    mine, theirs = cut(item), cut(doc)
    best = 0.0
    for k in range(max(len(theirs) - len(mine), 0) + 1):
        a, b = Counter(mine), Counter(theirs[k : k + len(mine)])
        best = max(best, (a & b).total() / (a | b).total())
    return best


def test_no_passage_from_the_bound_on_is_lost():
    draw = random.Random(5)
    items, docs = [], []
    for k in range(300):
        words = text(20_000 + k, draw.choice([9, 16, 25, 49, 50, 58, 59, 70, 100])).split()
        if k % 10 == 0:
            words = (words[:6] * 12)[:50]  # shingles that occur again and again
        items.append(" ".join(words))
        for _ in range(draw.choice([0, 1, 1, 1, 2])):
            words[draw.randrange(len(words))] = "edited"
        docs.append(" ".join([text(1, draw.randrange(40)), *words[draw.choice([0, 0, 0, 4]) :], text(2, draw.randrange(40))]))
    expected = {(k, k): brute_best(i, d) for k, (i, d) in enumerate(zip(items, docs, strict=True))}
    found = decontaminate.Index(items).matches(pa.array(docs))
    assert {p: s for p, (s, _) in found.items()} == pytest.approx({p: s for p, s in expected.items() if s >= decontaminate.LINK})
    assert sum(0.8 <= s < 0.87 for s in expected.values()) > 30 and sum(s < 0.8 for s in expected.values()) > 30


def test_long_items_are_met_by_any_of_their_parts():
    items, docs = [], []
    for k in range(40):
        words = text(60_000 + k, 604).split()
        items.append(" ".join(words))
        at, n = 59 + k, (58, 45, 30, 20)[k % 4]
        edited = [*words[:at], *(f"other{k}x{i}" for i in range(n)), *words[at + n :]]
        docs.append(" ".join([text(1, k), *edited, text(2, 40)]) if k < 20 else " ".join(words[100:]))  # or a copy without its beginning
    found = decontaminate.Index(items).matches(pa.array(docs))
    assert set(found) == {(k, k) for k in range(40)}
    assert all(found[k, k][0] == pytest.approx(brute_best(items[k], docs[k])) for k in range(0, 40, 7))


def test_matches_and_clean_documents(spark, benchmark, odd, nothing, clashing, monkeypatch):
    docs = spark.createDataFrame([(k, f"{text(k, 40)} {t} {text(k + 50, 9)}") for k, t in ITEMS] + [(100 + k, text(k, 60)) for k in range(30)], "doc_id long, text string")
    expected = [(k, k) for k in range(1, len(ITEMS))]
    for block in (decontaminate.ITEMS, 3):
        monkeypatch.setattr(decontaminate, "ITEMS", block)
        rows = decontaminate.matches(docs, benchmark).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in rows) == expected
        kept = decontaminate.without_passages(docs, benchmark)
        assert sorted(r["doc_id"] for r in kept.collect()) == [0] + [100 + k for k in range(30)]
    assert decontaminate.matches(odd, benchmark).collect() == [] == decontaminate.matches(nothing, benchmark).collect()
    assert decontaminate.without_passages(clashing, benchmark).columns == clashing.columns
    assert decontaminate.without_passages(odd, benchmark.limit(0)).count() == odd.count()


def check_packed(rows, lengths, capacity, per_source):
    bins = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        bins[r["shard"], r["bin"]].append(r)
        pieces[r["id"]].append(r)
    for group in bins.values():
        group.sort(key=lambda r: (r["begin"], r["n_words"]))
        assert all(a["begin"] + a["n_words"] == b["begin"] for a, b in zip(group[:-1], group[1:], strict=True))
        assert group[-1]["begin"] + group[-1]["n_words"] <= capacity
        assert max(Counter(r["source"] for r in group if r["source"] is not None).values(), default=0) <= per_source
        assert max(Counter(r["cluster"] for r in group if r["cluster"] is not None).values(), default=0) <= 1
    assert {k: sum(r["n_words"] for r in v) for k, v in pieces.items()} == lengths
    for v in pieces.values():
        v.sort(key=lambda r: r["piece"])
        assert [r["first_word"] for r in v] == [capacity * k for k in range(len(v))]
    return len(bins)


def test_packing_keeps_the_conflicts_and_all_words(spark):
    draw = random.Random(4)
    docs = [(k, draw.choice(["hot", "hot", "a", "b", "c", None]), draw.choice([None, None, 1, 2, k]), draw.choice([0, 1, 30, 99, 100, 101, 250, draw.randrange(100)])) for k in range(700)]
    rows = packing.packed(spark.createDataFrame(docs, "id long, source string, cluster long, length long"), capacity=100, per_source=2, shard=200).collect()
    check_packed(rows, {d[0]: d[3] for d in docs}, 100, 2)
    assert len({r["shard"] for r in rows}) == 4


def test_each_piece_takes_the_tightest_bin_without_conflict():
    draw, shelf, bins = random.Random(2), packing.Shelf(50, 1), []
    for _ in range(800):
        length, source, cluster = draw.randrange(0, 51), draw.choice("abcdef"), draw.choice([None, 1, 2, 3])
        fits = [(b["left"], k) for k, b in enumerate(bins) if b["left"] >= length and source not in b["sources"] and (cluster is None or cluster not in b["clusters"])]
        number, begin = shelf.place(length, source, cluster)
        if not fits:
            bins.append({"left": 50, "sources": set(), "clusters": set()})
        assert number == (min(fits)[1] if fits else len(bins) - 1) and begin == 50 - bins[number]["left"]
        bins[number]["left"] -= length
        bins[number]["sources"].add(source)
        bins[number]["clusters"].add(cluster)


def test_packing_does_not_depend_on_partitions(spark):
    draw = random.Random(5)
    docs = [(draw.choice([None, k // 2]), draw.choice(["a", "b", None]), draw.choice([None, 1, k]), draw.choice([1, 30, 30, 99, 250])) for k in range(600)]
    docs += [(7, "hot", None, 40)] * 300
    found = []
    for parts in (1, 5, 9):
        draw.shuffle(docs)
        df = spark.createDataFrame(docs, "id long, source string, cluster long, length long").repartition(parts)
        found.append(Counter(map(tuple, packing.packed(df, capacity=100, per_source=2, shard=250).collect())))
    assert found[0] == found[1] == found[2] and sum(found[0].values()) > 900


def test_packing_on_odd_rows(odd, nothing, clashing):
    rows = packing.packed_documents(odd).collect()
    assert sum(r["n_words"] for r in rows) == sum(r["length"] for r in rows if r["piece"] == 0)
    assert sum(r["piece"] == 0 for r in rows) == odd.count() == packing.packed_documents(clashing).where("piece = 0").count()
    assert packing.packed_documents(nothing).collect() == []


ARTICLE = "<h1>Head &amp; title</h1><p>First  <b>bold</b>\n text.<p>Second &eacute;&#233; one<br>two<ul><li>a<li>b</ul></p>"
BODY = "Head & title\n\nFirst bold text.\n\nSecond éé one two\n\na\n\nb"


@pytest.mark.parametrize(
    "html",
    [
        f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><a>Menu</a></nav><article>{ARTICLE}</article><footer>&copy; x</footer></body></html>",
        f"<body><header><h1>Site</h1></header><div class='ad'>Buy</div><main>{ARTICLE}<aside>Side</aside></main><script>var t='</p><article>no';</script>",
        f"<!-- <p>no</p> --><div id=content>{ARTICLE}</div><div class='cookie-notice'>Accept</div><form>Name<input value='x>y'></form>",
        f"<article class='post has-sidebar'>{ARTICLE}<div class='comments'><article class='comment'><p>Reader</p></article></div></article><div role=search>s</div>",
        f"<ARTICLE>{ARTICLE}<p hidden>no</p><div style='display: none'>no</div><noscript>no</noscript><textarea>no</p></textarea></ARTICLE><p>outside</p><foot",
        f"<article>{ARTICLE}<!-- cut",
    ],
)
def test_main_text_of_layouts(html):
    assert html_extract.main_text(html, set()) == BODY


@pytest.mark.parametrize("html", [None, "", "<", "<p", "<script>x", "<!--", "&amp", "a < b", "<p>" * 5000, "</p>" * 100, "<a title=\"x>" * 50])
def test_odd_html_is_read(html):
    assert isinstance(html_extract.main_text(html, set()), str)


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ('<div id="content" class="article search-history"><p>The article text</p></div><div class="comments">c</div>', "The article text"),
        ('<article><p>a</p><div class="widget-body"><p>b</p></div><div class="comments-list"><p>c</p></div></article>', "a\n\nb"),
        ('<div class="sign-up-share-price"><p>price</p></div><div class="site-footer">f</div><div class="ad-box-2">x</div>', "price"),
        ('<div class="search"><p>all there is</p></div>', "all there is"),
        ('<div class="header-x header">h</div><article><div class="header">t</div>x</article>', "t\n\nx"),
    ],
)
def test_names_choose_among_slots(html, expected):
    assert html_extract.main_text(html, set()) == expected


@pytest.mark.parametrize("html", ["<div>" * 100_000 + "<p>x", "<span>" * 100_000 + "</b>" * 100_000 + "x", "<p><div>" + "<span>" * 50_000 + "<h1></h1>" * 50_000 + "x"])
def test_deep_nesting_costs_no_square(html):
    started = time.monotonic()
    assert html_extract.main_text(html, set()) == "x"
    assert time.monotonic() - started < 20


def _hosts():
    """Hosts without any hints: fixed blocks and one short story a page; and pages of every kind beside."""
    fixed = lambda k: f"<div>{text(900, 25)}</div><div><p>{text(901, 25)}</p></div><table><tr><td>{text(902, 25)}</td></tr></table>"
    rows = [(k, "http://few.example/", f"<body>{fixed(k)}<div><p>{text(k, 6)}</p></div></body>") for k in range(12)]
    rows += [(50 + k, "http://four.example/", f"<body>{fixed(k)}<div><p>{text(50 + k, 6)}</p></div></body>") for k in range(4)]
    rows += [(100 + k, "http://copies.example/", f"<body><div class=ad>ad {k}</div><div><p>{text(100, 40)}</p></div></body>") for k in range(9)]
    rows += [(150 + k, "http://menu.example/", f"<body><div>{''.join(f'<b>{text(950 + i, 2)}</b>' for i in range(4))}</div><p>{text(150 + k, 7)}</p></body>") for k in range(6)]
    rows += [(200 + k, "http://mixed.example/", f"<body><ul>{'<li>more</li>' * (k % 3)}</ul>{fixed(k) if k else ''}<p>{text(200 + k // 2, 9)}</p></body>") for k in range(10)]
    rows += [(300, "http://few.example/empty", f"<body>{fixed(0)}<div><p></p></div></body>")]
    return rows


def test_template_and_its_slots_against_row_by_row_code(spark):
    rows = _hosts()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = {r["page_id"]: r["text"] for r in html_extract.extracted(pages).collect()}
    assert all(found[k] == text(k, 6) for k in (*range(12), *range(50, 54)))
    assert all(found[150 + k] == text(150 + k, 7) for k in range(6))
    assert all(found[100 + k] == text(100, 40) for k in range(9))
    assert all(word in found[300] for word in (text(900, 25), text(901, 25), text(902, 25)))
    by_host = {}
    for page, url, html in rows:
        by_host.setdefault(url.split("/")[2], []).append((page, html))
    for host in by_host.values():
        template = brute.template([html for _, html in host], html_extract)
        assert template or host[0][0] == 100
        assert all(found[page] == html_extract.main_text(html, template) for page, html in host)
        assert host[0][0] == 100 or all(html_extract.main_text(html, set()) != found[page] for page, html in host[1:4])


def test_a_host_of_many_pages_meets_several_copies_of_its_template(spark, monkeypatch):
    rows = [r for r in _hosts() if r[0] < 60]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = sorted(tuple(r) for r in html_extract.extracted(pages).collect())
    monkeypatch.setattr(html_extract, "PART", 3)
    assert sorted(tuple(r) for r in html_extract.extracted(pages).collect()) == whole
    plain = pages.select(F.col("page_id").alias("id"), "url", "html", F.col("url").alias("host"))
    dealt, copies = html_extract._dealt(plain, spark.createDataFrame([("http://few.example/", [1])], "host string, tokens array<long>"))
    parts = {r["part"] for r in copies.collect()}
    assert parts == set(range(4)) and {r["part"] for r in dealt.where("host = 'http://few.example/'").collect()} <= parts


def test_template_texts_of_a_host_go(spark):
    page = lambda k, extra: f"<body><div class=top>Welcome to us</div><div>{text(k, 30)}<p>{text(k + 50, 20)}</p><span>Read more about us</span></div>{extra}</body>"
    rows = [(k, f"http://u@A.example:80/{k}", page(k, "<p>Open daily</p>")) for k in range(12)]
    rows += [(100 + k, "http://b.example/", page(7, "")) for k in range(12)]  # the same page again and again is no template
    rows += [(200 + k, "//c.example", page(k, "")) for k in range(3)]  # too few pages
    rows += [(300, None, None), (301, "", "<p>x</p>"), (None, "http://a.example/z", None)]
    found = {r["page_id"]: r["text"] for r in html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(found) == len(rows)
    assert all(found[k] == f"{text(k, 30)}\n\n{text(k + 50, 20)}" for k in range(12))
    assert all("Welcome to us" in found[k] for k in (100, 111, 200, 202)) and found[300] == "" and found[301] == "x"
    none = html_extract.extracted(spark.createDataFrame([], "page_id long, url string, html string"))
    assert none.collect() == []


def test_extra_columns_of_pages_do_not_matter(spark):
    rows = spark.createDataFrame([(1, "http://a/", "<p>x</p>", "e", "e", 3)], "page_id long, url string, html string, host string, tokens string, id int")
    assert [tuple(r) for r in html_extract.extracted(rows).collect()] == [(1, "http://a/", "x")]
