"""Decontamination, language identification, TIFF, HTML, URL filter."""

from __future__ import annotations

import html as escaping
import random
import re
import struct
import zlib
from functools import cache

import duckdb
import numpy as np
import pytest

from larkspur.llm import common, decontaminate, html, langid, registry, tiff, url_filter


# Decontamination


def levenshtein(item, text):
    """The least edit distance of ``item`` to any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_bit_parallel_distance():
    rng = random.Random(4)
    for _ in range(300):
        item, text = ([rng.randrange(4) for _ in range(rng.randint(1, n))] for n in (12, 30))
        distance, end = decontaminate.edit_distance_within(item, text)
        assert distance == levenshtein(item, text) and 0 <= end <= len(text)


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        at, kind = rng.randrange(len(w)), rng.randrange(3)
        w[at : at + (kind > 0)] = [] if kind == 2 else [f"q{rng.randrange(10**6)}"]
    return w


def test_leaks_against_brute_force(spark):
    """Rows are right without exception, and recall is at least 0.9 up to the greatest edit rate."""
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, [rng.choice(vocabulary) for _ in range(rng.randint(8, 50))]) for i in range(25)]
    docs = []
    for n in range(150):
        filler = lambda: [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        i, w = rng.choice(items)
        inside = edited(rng, w, rng.randint(0, int(0.15 * len(w)))) if n % 3 else []
        docs.append((n, [*filler(), *inside, *filler()]))
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs] + [(900, None), (901, ""), (None, " ".join(items[0][1]))], "doc_id long, text string")
    bench = spark.createDataFrame([(i, "  ".join(w).upper()) for i, w in items] + [(98, None), (None, "no id " * 9)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(df, bench).collect()}
    expected = {(d, i): e for d, w in docs for i, x in items if (e := levenshtein(x, w)) <= int(0.15 * len(x))}
    expected[None, 0] = 0
    assert set(got) <= set(expected) and all(got[k].distance >= expected[k] for k in got)
    assert len(got) >= 0.9 * len(expected)
    assert all(k in got for k, e in expected.items() if e == 0)
    text = {d: " ".join(w) for d, w in docs}
    for (d, i), r in got.items():
        if d is not None and r.distance == 0:
            assert text[d][r.start : r.end] == " ".join(dict(items)[i])
    assert decontaminate.find_leaks(df.limit(0), bench).count() == 0 == decontaminate.find_leaks(df, bench.limit(0)).count()


@cache
def long_items():
    rng = random.Random(5)
    items = [(i, [f"w{rng.randrange(4000)}" for _ in range(60)]) for i in range(20)]
    return items, decontaminate.ItemIndex([(i, " ".join(w)) for i, w in items], decontaminate.Options())


@pytest.mark.parametrize("way", ["replaced", "inserted", "removed"])
@pytest.mark.parametrize("place", ["last", "first", "inside"])
def test_recall_of_each_way_to_edit(way, place):
    """At the greatest number of edits, wherever the text is in its batch and the item in its text."""
    rng, (items, index) = random.Random(5), long_items()
    other = lambda: " ".join(f"o{rng.randrange(4000)}" for _ in range(80))
    found = 0
    for n in range(80):
        i, w = items[n % 20]
        w = list(w)
        for _ in range(9):
            at = rng.randrange(len(w))
            w[at : at + (way != "inserted")] = [] if way == "removed" else [f"q{rng.randrange(10**6)}"]
        text = " ".join([other(), *w])
        batch = {"last": [text], "first": [text, other()], "inside": [f"{text} {other()}"]}[place]
        got = index.search(batch)
        found += any(r[:2] == (0, i) for r in got)
        if place == "first":  # what follows in the batch changes nothing
            assert [r for r in got if r[0] == 0] == index.search([text])
    assert found >= 0.9 * 80


def test_short_items_and_too_few_repetitions():
    """Items too short for an edit match where they occur; without enough repetitions all windows are verified."""
    index = decontaminate.ItemIndex([(1, "yes"), (2, "forty two"), (3, "a b c d")], decontaminate.Options())
    assert [(r[1], r[4], r[5]) for r in index.search(["A b, c: D", "x Yes", "42 forty-two", None])] == [(3, 0, 9), (1, 2, 5), (2, 3, 12)]
    rng = random.Random(2)
    w = [f"w{rng.randrange(50)}" for _ in range(40)]
    index = decontaminate.ItemIndex([(7, " ".join(w))], decontaminate.Options(most_repeats=1, sampled=30))
    assert index.classes[0][2] is None
    for _ in range(50):
        assert [r[1] for r in index.search([" ".join(edited(rng, w, 6))])] == [7]


def test_planted_passages(spark, sf):
    found = {(r.doc_id, r.item_id) for r in registry.op8_benchmark_cgk(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    assert {(d.doc_id, i.item_id) for d in docs for i in items if i.text in (d.text or "")} <= found


# Language identification


def chain(scores, starts, t, first):
    """Marginals by summing over all paths of each sequence."""
    from itertools import product

    k, out = scores.shape[1], np.zeros_like(scores)
    cuts = [*np.flatnonzero(starts), len(scores)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        total = 0
        for path in product(range(k), repeat=b - a):
            w = np.exp(first[path[0]] + sum(scores[a + i, y] for i, y in enumerate(path)) + sum(t[x, y] for x, y in zip(path, path[1:], strict=False)))
            total += w
            for i, y in enumerate(path):
                out[a + i, y] += w
        out[a:b] /= total
    return out


def test_forward_backward_is_exact():
    rng = np.random.default_rng(1)
    for lengths in ([1], [1, 1, 5], [6, 2, 1, 4], [3] * 7):
        n = sum(lengths)
        starts = np.zeros(n, bool)
        starts[np.cumsum([0, *lengths[:-1]])] = True
        scores, t, first = rng.normal(size=(n, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
        assert np.allclose(langid.forward_backward(scores, starts, t, first)[0], chain(scores, starts, t, first))


def test_language(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in registry.op5_language_crf(spark, sf).collect()}
    assert all(got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1) for d in docs)
    held = [d for d in docs if got[d.doc_id].held_out and d.lang and d.text]
    assert sum(got[d.doc_id].lang_pred == d.lang for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_odd_rows(spark):
    model = langid.train([("the cat and the dog " * 9, "en"), ("der hund und die katze " * 9, "de")])
    df = spark.createDataFrame([(1, None), (2, ""), (3, "123 ²!"), (None, "the dog"), (5, "der hund " * 3000), (5, "die katze")], "doc_id long, text string")
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict(df, model).collect()]
    assert got[:3] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)] and [x[1] for x in got[3:]] == ["en", "de", "de"]
    assert [w[1] for w in langid.label_words(model, "the cat und die katze")] == ["en", "en", "de", "de", "de"]
    assert langid.label(langid.train([]), ["x"]) == [("und", 0.0)] and langid.training_rows(df.selectExpr("doc_id", "text", "cast(null as string) lang")) == []


# TIFF


@pytest.mark.parametrize("scheme", [tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("tile", [0, 16])
@pytest.mark.parametrize("order", "<>")
@pytest.mark.parametrize("predictor", [1, 2])
def test_tiff_round_trip(scheme, tile, order, predictor):
    rng = random.Random(7)
    for payload in (bytes(64), bytes(rng.choices(b"ab \0", k=64 * 130)), rng.randbytes(64 * 170)):
        data = tiff.write_tiff(payload, scheme=scheme, tile=tile, order=order, predictor=predictor, page_rows=60, strip_rows=25)
        pages = list(tiff.read_tiff(data))
        assert b"".join(p.pixels.tobytes() for p in pages) == payload and len(pages) == -(-len(payload) // 64 // 60)


def test_known_codes():
    assert tiff.lzw_decode(tiff.lzw_encode(b"aaaaaaaaab" * 700), 7000) == b"aaaaaaaaab" * 700
    assert tiff.packbits_decode(bytes.fromhex("FEAA0280002AFDAA0380002A22F7AA"), 24) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22AAAAAAAAAAAAAAAAAAAA")


def test_tiff_pages(spark):
    good = tiff.write_tiff(bytes(range(64)) * 3, page_rows=2)
    rows = [(1, good), (2, None), (3, b""), (4, good[:40]), (5, b"II*\0\xff\0\0\0"), (1, good)]
    df = spark.createDataFrame([(i, None if b is None else bytearray(b)) for i, b in rows], "id int, media binary")
    got = tiff.pages(df, key="id").collect()
    assert [(r.page, r.width, r.height, r.error) for r in got if r.id == 1] == [(0, 64, 2, None), (1, 64, 1, None)] * 2
    assert {r.id for r in got} == {1, 3, 4, 5} and all(r.error for r in got if r.id > 2)


@pytest.mark.parametrize("tag, value", [(tiff.HEIGHT, 40), (tiff.HEIGHT, 2_000_000), (tiff.WIDTH, 2_000_000), (tiff.WIDTH, 0), (tiff.STRIP_ROWS, 1), (tiff.SAMPLES, 9)])
@pytest.mark.parametrize("tile", [0, 16])
def test_directories_that_say_more_than_the_data(tag, value, tile):
    """No pixel is left undefined, and no memory is taken for what isn't there."""
    data = bytearray(tiff.write_tiff(bytes(range(64)) * 32, strip_rows=16, tile=tile))
    (at,) = struct.unpack_from("<I", data, 4)
    for i in range(struct.unpack_from("<H", data, at)[0]):
        entry = at + 2 + 12 * i
        if struct.unpack_from("<H", data, entry)[0] == tag:
            struct.pack_into("<I", data, entry + 8, value)
            with pytest.raises(tiff.TiffError):
                list(tiff.read_tiff(bytes(data)))


def test_small_data_that_stands_for_much():
    assert len(tiff._decoded(zlib.compress(bytes(10**8)), tiff.DEFLATE, 1000)) == 1000
    assert len(tiff._decoded(tiff.lzw_encode(bytes(10**6)), tiff.LZW, 1000)) < 10_000
    assert len(tiff._decoded(tiff.packbits_encode(bytes(10**6)), tiff.PACKBITS, 1000)) < 2000


def test_directories_in_a_circle():
    data = bytearray(tiff.write_tiff(bytes(64)))
    data[-4:] = data[4:8]
    with pytest.raises(tiff.TiffError, match="circle"):
        list(tiff.read_tiff(bytes(data)))


def test_tiff_query(spark, sf):
    import hashlib

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in registry.op6_tiff(spark, sf).collect()}
    for d in docs:
        payload, n = tiff.text_payload(d.text or "")
        r = got[d.doc_id]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert tiff.text_payload("") == (bytes(64), 0) and len(tiff.text_payload("x" * 64)[0]) == 64


# HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) "</p>"</script></head><body><header>Site name</header><nav><ul><li><a href=x>Home</a></ul></nav>
<!-- <p>no</p> --><div class="ad-box">Buy &amp; save now, today.</div><article><h1>A  title</h1><p>First <b>bold
text, with&nbsp;more.<br><p>Second &lt;one&gt;, ends.<ul><li>item one, yes<li>item two</ul></article><aside><p>Read also this, and that.</p></aside>
<section id="comments"><p>Nice text, thanks.</p></section><form><p>Name, please.</p></form><div class='cookie notice'>We use cookies.</div><footer>&copy; all</footer>"""


def test_page():
    assert html.main_text(PAGE) == "A title\nFirst bold text, with more.\nSecond <one>, ends.\nitem one, yes\nitem two"


def plain(page):
    """A page without the words and elements that tell what is what."""
    return re.sub(r"<(/?)(?:article|nav|aside|footer|section|form|header|main)\b[^>]*>", r"<\1div>", re.sub(r' class="[^"]*"', "", page))


def article_of(page):
    inside = re.search(r"<article>(.*?)(?:</article>|<footer|$)", page, re.S)[1]
    parts = (" ".join(escaping.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(b for b in parts if b)


def test_ratios_decide_without_names(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    found = [html.blocks(p) for p in pages]
    rejected = sum(not good for f in found for good in html.content(f))
    assert rejected > 0.3 * sum(map(len, found))
    assert all(html.main_text(re.sub(r' class="[^"]*"', "", p)) == article_of(p) for p in pages)
    long = [p for p in pages if len(article_of(p)) >= 1000]
    assert sum(html.main_text(plain(p)) == article_of(p) for p in long) >= 0.9 * len(long) > 9


PROSE = "Long text, with marks. " * 20


@pytest.mark.parametrize("page, text", [
    (f"<div><p>{PROSE}</p><ul>{'<li><a href=x>More stories</a>' * 6}</ul></div>", PROSE.strip()),
    (f"<div>{PROSE}</div><div><a href=1>Home</a> | <a href=2>About us</a></div>", PROSE.strip()),
    (f"<div><a name=x><p>{PROSE}</p><p>{PROSE}</p></div>", f"{PROSE.strip()}\n{PROSE.strip()}"),
    (f"<div><h2>Part</h2><p>{PROSE}</p><ul><li>one item</li><li>two</li></ul></div>", f"Part\n{PROSE.strip()}\none item\ntwo"),
    (f"<div><div><p>{PROSE}</p></div><div><p>Short one.</p></div></div>", f"{PROSE.strip()}\nShort one."),
])
def test_ratios_on_small_pages(page, text):
    assert html.main_text(f"<html><body>{page}</body></html>") == text


ARTICLE = "".join(f"<p>Paragraph {i} of the article, which goes on for a while, and then it ends.</p>" for i in range(6))
FRAME = '<html><body><nav><a href=x>Home</a></nav>{}<div class="sidebar"><p>Other things, not of the article.</p></div><div class="comments"><p>' + "A reader says a lot, and more than the article does. " * 40 + "</p></div></body></html>"


@pytest.mark.parametrize("element", [
    '<div class="content">', '<div class="content with-sidebar">', '<div class="post-content no-ads">', '<div class="story share-enabled">', '<div class="article search-result">',
    '<div class="page has-comments">', '<div class="notice-board-article">', '<article class="post has-related">', '<main id="main-with-sidebar" class="widget content">', '<div class="notice">',
])
def test_no_article_is_lost_to_a_name(element):
    """Nor is a sidebar or a reader's comment kept, which here outweighs the article."""
    text = "\n".join(f"Paragraph {i} of the article, which goes on for a while, and then it ends." for i in range(6))
    tag = re.match(r"<(\w+)", element)[1]
    assert html.main_text(FRAME.format(f"{element}{ARTICLE}</{tag}>")) == text
    assert html.main_text(FRAME.format(f'<div id="wrap-sidebar">{element}<h1>Head</h1>{ARTICLE}<div class="share">Share it.</div></{tag}></div>')) == f"Head\n{text}"


def test_articles_of_one_name_and_comments_in_articles():
    many = "".join(f'<div class="story share-enabled">{ARTICLE}</div>' for _ in range(3))
    assert html.main_text(f"<body>{many}</body>").count("Paragraph 5") == 3
    cards = '<div class="related"><article class="card"><p>Another story, in short.</p></article></div>'
    comments = '<section class="comments"><article class="comment"><p>' + "I think so, too. " * 99 + "</p></article></section>"
    assert html.main_text(f"<body><article>{ARTICLE}</article>{cards}{comments}</body>").count("\n") == 5
    assert html.main_text("<div class=ad>" * 20_000 + "x") in ("", "x")


def test_ties_keep_all_in_page_order():
    assert html.main_text("<div><p>a b.</p><p>a b.</p></div>") == "a b.\na b."


@pytest.mark.parametrize("page", ["<div>x" * 20_000, "<p>" + "<blockquote>x" * 20_000 + "</section>" * 20_000, "<b>" * 20_000 + "x" + "</i>" * 20_000, "<ul><li>x" * 20_000])
def test_deep_pages_take_linear_time(page):
    import time

    began = time.process_time()
    html.main_text(page)
    assert time.process_time() - began < 5


@pytest.mark.parametrize("text", ["", "   ", "<", "<p", "<p class='x", "<<<>>>", "</p></div>", "&#0;&#x110000;", "<script>never ends", "<!-- never ends", "<p>" * 3000, "x" * 100_000])
def test_broken_pages(text):
    assert isinstance(html.main_text(text), str)


def test_pages_of_the_tables(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r.page_id: r for r in registry.op10_tag_paths(spark, sf).collect()}
    for p in pages:
        article = re.search(r"<article>(.*?)(?:</article>|<footer|$)", p.html, re.S)[1]
        blocks = (" ".join(escaping.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert got[p.page_id].text == "\n".join(b for b in blocks if b) and got[p.page_id].n_chars == len(got[p.page_id].text)


def test_empty_and_clashing_tables(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>", "x")], "page_id long, url string, html string, text string")
    assert html.extract(pages.limit(0)).count() == 0 and html.extract(pages, keys=("page_id", "html")).first().text == "a"
    docs = spark.createDataFrame([(1, "the dog", 0.5), (None, None, None), (1, "the dog", 0.5)], "doc_id long, text string, score double")
    model = langid.train([("the cat and the dog " * 9, "en"), ("der hund und die katze " * 9, "de")])
    assert langid.predict(docs.limit(0), model).count() == 0
    assert langid.predict(docs, model, keys=("doc_id", "score"), names=("l", "s")).where("l = 'en'").count() == 2
    files = tiff.encode_texts(docs)
    assert tiff.encode_texts(docs.limit(0)).count() == 0 == tiff.pages(files.limit(0), key="doc_id").count()
    assert sorted((r.doc_id or 0, r.payload_bytes) for r in tiff.payload_digests(files, key="doc_id").collect()) == [(0, 64), (1, 64), (1, 64)]


def test_null_pages(spark):
    df = spark.createDataFrame([(1, None, None), (None, "u", "<p>a</p>"), (1, "u", "")], "page_id long, url string, html string")
    assert [(r.page_id, r.text, r.n_chars) for r in html.extract(df).collect()] == [(1, "", 0), (None, "a", 1), (1, "", 0)]


# URL filter


def test_urls_against_sql(spark):
    rng = random.Random(8)
    hosts = ["a.net", "b.org", "x.example.com", "Y.Example.NET", "shop.io", "shop.io", "shop.io"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr', 'p'])}/{rng.choice(['a', 'b', str(rng.randrange(99)), f's{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}'])}{rng.choice(['', '/', '.html', '?q=/x', '#f', '/c/d/e/f'])}" for _ in range(600)]
    urls += [None, "", "no scheme", "http://", "https://UPPER.NET", "ftp://u@h.org:8/fr/x", "http://net/", "http://notnet/", "x://a.example.net/en/1", "://b.org/fr/"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, urls[0], "h"), (0, urls[0], "h")], "page_id long, url string, host string")
    options = url_filter.Options(children=5, share=0.1)
    got = sorted(tuple(map(str, r)) for r in url_filter.judge(df, registry.URL_RULES, options=options).collect())
    con = duckdb.connect()
    con.sql("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [(r.page_id, r.url) for r in df.collect()])
    want = con.sql(url_filter.judge_sql(registry.URL_RULES, depth=8, options=options))
    assert want.columns == ["page_id", "host", "path", "rule", "verdict", "template"]
    assert got == sorted(tuple(map(str, r)) for r in want.fetchall())
    by = {r[0]: r for r in got}
    assert by[str(len(urls) - 2)][1:5] == ("a.example.net", "/en/1", "example.net/en/", "allow") and by[str(len(urls) - 3)][3] == "None"
    assert url_filter.judge(df.limit(0), registry.URL_RULES).count() == 0


def judged(spark, rows, rules=(), **options):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, label string")
    return {r.page_id: (r.verdict, r.template) for r in url_filter.judge(df, rules, label_column="label", options=url_filter.Options(**options)).collect()}


def test_impure_templates_are_rejected(spark):
    """Labelled rows decide for the others of their template, however few they are among these."""
    rows = [(f"http://h.io/bad/{i}", "block" if i < 12 else None) for i in range(60)]
    rows += [(f"http://h.io/good/{i}", "allow") for i in range(12)] + [(f"http://h.io/none/{i}", None) for i in range(9)]
    got = judged(spark, rows)
    assert all(got[i] == ("block", "/bad/*") for i in range(60))
    assert all(got[i][0] == "allow" for i in range(60, len(rows)))


def test_branches_merge_at_all_levels(spark):
    """Alike siblings share evidence that none has alone; an unlike one and one without labels stay apart."""
    rows = []
    for topic in "abcdefgh":
        rows += [(f"http://h.io/x/y/{topic}/page/{i}", "block" if i == 1 else None) for i in (1, 2)]
    rows += [(f"http://h.io/x/y/fine/page/{i}", "allow" if i < 40 else None) for i in range(41)] + [("http://h.io/x/y/new/page/1", None)]
    rows += [(f"http://g.io/{i}", "block" if i % 2 else "allow") for i in range(80)]
    got = judged(spark, rows)
    assert {got[i][0] for i in range(16)} == {"block"} and got[0][1] == "/x/y/a/page/*"
    assert got[56] == ("allow", "/x/y/fine/page/*") and got[57][0] == "allow"


def test_deep_paths_and_labels_by_rule(spark):
    rules = (url_filter.Rule("h.io", "/b/", "block"),)
    deep = "/".join(["c"] * 12)
    rows = [(f"http://h.io/b/{i}", None) for i in range(5)] + [(f"http://h.io/{deep}", None)]
    got = judged(spark, rows, rules)
    assert got[5] == ("allow", f"/{deep}") and got[0] == ("block", "/b/*")


def test_depth_costs_no_rounds(spark, monkeypatch):
    """A chain of 300 segments, a trap of 60 paths each of which goes on from the one before, and branches below both."""
    rounds = []
    monkeypatch.setattr(url_filter, "written", lambda df, name: rounds.append(name) or common.written(df, name))
    chain = "/".join(f"c{chr(97 + i % 26)}" for i in range(300))
    rows = [(f"http://h.io/{chain}/x{chr(97 + i % 26)}{chr(97 + i // 26)}", None) for i in range(60)]
    rows += [("http://t.io" + "/a" * i, None) for i in range(1, 61)] + [(f"http://t.io{'/a' * 30}/b{chr(97 + i)}", None) for i in range(26)]
    got = judged(spark, rows)
    assert {got[i][1] for i in range(60)} == {f"/{chain}/*"} and got[60 + 59][1] == "/a" * 60
    assert {got[i][1] for i in range(120, 146)} == {"/a" * 30 + "/*"}
    assert rounds.count("tree") == 2 and rounds.count("merged") == 0


def test_none_of_the_tables_unruled_pages_has_evidence(spark):
    """No template holds both labelled and other pages there, so nothing is rejected but by rule."""
    got = url_filter.judge(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), registry.URL_RULES).collect()
    ruled = {(r.host, r.template) for r in got if r.rule is not None}
    assert all(r.verdict == "allow" and (r.host, r.template) not in ruled for r in got if r.rule is None)
