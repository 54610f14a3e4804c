"""Tokens, pages, quality, decontamination, licences: exact references, brute force, held-out accuracy, odd inputs."""

import random
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL

from pairwright.llm import decontam, html_text, licenses, quality, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Null and clashing columns, empty, short and long texts, repeated rows.
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \n\t ", "en", "a", 3), (4, "word", None, "a", 4), (4, "word", None, "a", 4),
    (None, "no id here at all", "en", None, 1), (5, "long " * 60_000, "en", "b", 1), (6, "Größe 😀 <|endoftext|> it's", "de", "b", 2), (7, "x" * 50_000, "xx", "b", 3),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# Tokens


def test_token_counts_are_the_library_s(spark, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.vocabulary_path())
    for docs in (odd, documents(spark)):
        texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        rows = tokens.count_tokens(docs).collect()
        assert len(rows) == docs.count()
        for r in rows:
            text = texts[r.doc_id] or ""
            n = len(library.encode(text, add_special_tokens=False))
            assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(text.encode()), n > 2048)


@pytest.mark.parametrize("text", ["a<|startoftext|>b <|endoftext|>", "<|STARTOFTEXT|>", "ΑΣ ΑΣ.", "a\x1cb c d", "é ́x İstanbul", "don't WE'LL", "\x85x\x1d \x1e", "日本語 12.5", "'s"])
def test_words_cut_at_white_space_give_whole_counts(text):
    from tokenizers import Tokenizer

    path = tokens.vocabulary_path()
    lengths = tokens.WordLengths(path, tokens.frequent_words(path))
    assert lengths.total(text) == len(Tokenizer.from_file(path).encode(text, add_special_tokens=False))


def test_the_table_holds_the_corpus_frequent_words(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"größer größer größer 的 的 的 rare{i} ñandú ñandú") for i in range(40)] + [(99, None), (98, "")], "doc_id long, text string")
    assert tokens.count_words(docs, 3) == ["größer", "的", "ñandú"]
    monkeypatch.setattr(tokens, "COUNTED_WORDS", 20)
    assert tokens.count_words(docs, 3) == ["größer", "的", "ñandú"]
    path = tokens.vocabulary_path()
    words = ["größer", "的", "ñandú", "a<|endoftext|>b", "x" * 400]
    table = tokens.frequent_words(path, words)
    alone = tokens.WordLengths(path)
    assert table.find([*words, "other"]) == {w: alone.total(w) for w in words}
    assert tokens.frequent_words(path, []).find(["a"]) == {}


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 10)
    path = tokens.vocabulary_path()
    lengths = tokens.WordLengths(path, {})
    for i in range(30):
        lengths.total(f"q{i} z{i} y{i}")
        assert len(lengths) <= 10


def test_empty_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    labels, bench = spark.createDataFrame([], "doc_id long, quality int, toxic int"), spark.createDataFrame([], "item_id long, text string")
    assert tokens.count_tokens(empty).count() == 0
    assert quality.score(empty, quality.train(empty, labels)).count() == 0
    assert decontam.find_leaks(empty, bench).count() == 0
    assert licenses.scan_files(empty).count() == 0
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# Pages

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body><header class="site-header"><h1>Site</h1></header>
<div id="nav-top" class="menu"><a href=x>Home</a></div><div class="wrap"><div class="cookie-notice">We use cookies</div>
<div class="post post-12"><h1>Title &amp; more</h1><p>First&nbsp;para with <b>bold</b> <a href="q>z">link</a>.<p>Second <script>var a="</p>";</script><ul><li>one<li>two</ul>
<div class="ad">buy</div><!-- <p>gone</p> --><blockquote>quote 1 < 2</blockquote></div><section id="comments"><p>nice post!!!</p></section></div>
<aside>side</aside><form>f<input></form><footer>&copy; foot</footer></body></html>"""


def test_article_without_its_surroundings():
    assert html_text.extract(PAGE, None) == "Title & more\nFirst para with bold link.\nSecond\none\ntwo\nquote 1 < 2"


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>cut off</p", "cut off"), ("<p>a<p>b", "a\nb"), ("<nav>menu</nav>", ""), ("<p>&am", "&am"),
    ("<article><h1>t</h1><p>x<br>y</article>", "t\nx y"), ("</p></div>odd</b>", "odd"), ("<p title='a>b'>q</p>", "q"), ("<p>x</p><script>never ends", "x"),
])
def test_odd_pages(html, text):
    assert html_text.extract(html, None) == text


ARTICLE = "<h1>Title</h1><p>First para of the article, with some words.<p>Second para of it."
BODY = "Title\nFirst para of the article, with some words.\nSecond para of it."
AROUND = "<nav>menu</nav><div class='sidebar'>aside</div><div class='cookie-notice'>We use cookies</div><footer>foot</footer>"


@pytest.mark.parametrize("html", [
    f"<div class='layout has-sidebar'>{ARTICLE}</div>", f"<div class='no-sidebar'><article>{ARTICLE}</article></div>", f"<div class='content with-ads'><main>{ARTICLE}</main></div>",
    f"<form id='aspnetForm' action='x'><div>{ARTICLE}</div>{AROUND}</form>", f"<form><p>lone</p>{AROUND}<div class='content with-ads'>{ARTICLE}</div></form>".replace("<p>lone</p>", ""),
])
def test_marks_do_not_hold_for_wrappers_of_the_article(html):
    assert html_text.extract(f"<body>{html}{AROUND}</body>", None) == BODY
    assert html_text.votes(f"<body>{html}{AROUND}</body>")


def test_marks_hold_for_what_stands_beside_the_article():
    long = "<p>nice post, really a very long reply to all of it</p>" * 9
    for beside in (f"<div id='comments'><article class='comment-body'>{long}</article></div>", f"<div class='comments-area'>{long}</div>", f"<div class='sidebar'>{long}</div>", "<form><p>Name</p><p>Mail</p></form>", f"<nav>{long}</nav>"):
        assert html_text.extract(f"<body><div class='post'>{ARTICLE}</div>{beside}{AROUND}</body>", None) == BODY
        assert html_text.extract(f"<body><div class='has-sidebar'>{ARTICLE}{beside}</div>{AROUND}</body>", None) == BODY


def test_hosts_vote_and_every_page_comes_back(spark):
    rows = [(i, f"http://Host.example/{i}", PAGE.replace("post-12", f"post-{i}")) for i in range(6)]
    rows += [(7, None, "<p>lone</p>"), (8, "not a url", None), (8, "not a url", None), (9, "http://host.example/x", "<body><main><p>" + "other layout " * 40 + "</p></main></body>")]
    pages = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, host int")
    got = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    assert html_text.extract_text(pages).count() == 10
    assert got[3].startswith("Title & more") and got[7] == "lone" and got[8] == "" and got[9].startswith("other layout")
    named = pages.drop("host").withColumn("host", html_text.F.lit("h"))
    winner = html_text.host_paths(named.filter("page_id < 6")).first()
    assert winner.winner.endswith("div.post.post-#")


@pytest.mark.parametrize("unclosed", ["<svg viewBox='0 0 1 1'>", "<select name=x>", "<canvas>", "<math>", "<object data=x>", "<noscript>", "<iframe src=x>", "<template>"])
def test_unclosed_elements_do_not_take_the_rest(unclosed):
    html = f"<body><div class='post'><h1>Title</h1><p>First para.</p>{unclosed}<p>Second para of it.</p><p>Third.</p></div></body>"
    assert html_text.extract(html, None) == "Title\nFirst para.\nSecond para of it.\nThird."


@pytest.mark.parametrize(("html", "text"), [
    ("<p>a <svg><svg><text>no</text></svg><text>no</text></svg> b</p>", "a b"), ("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then</p>", "if x=2 then"),
    ("<p>press <button>Start</button> now</p>", "press Start now"), ("<p>x</p><div><button>Menu</button></div><p>y</p>", "x\ny"), ("<p>a</p><select><option>b</select><p>c</p>", "a\nc"),
    ("<div class='post'><p>one of the words</p><p class='side'>two of the words</p><p class='foot-note'>three</p><p class='alert'>four</p><p class='ad'>five</p></div>", "one of the words\ntwo of the words\nthree\nfour"),
])
def test_what_belongs_to_a_paragraph(html, text):
    assert html_text.extract(html, None) == text


def test_deep_pages_take_linear_time():
    import time

    def seconds(n):
        began = time.perf_counter()
        text = html_text.extract("<div class=a>" * n + "<p>some text</p>" * n + "</section>" * n + "</div>" * n, None)
        assert text == "\n".join(["some text"] * n)
        return time.perf_counter() - began

    seconds(200)
    assert seconds(12_000) < 20 * max(seconds(1_500), 0.02)


class SlowReader(HTMLParser):
    """An independent reader for the given pages: the tree by the library's parser, then every block of the element article."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks = [], [[]]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in html_text.VOID:
            self.blocks[-1].append(" ")
        elif tag in html_text.BLOCKS | html_text.CONTAINERS:
            self.blocks.append([])
        if tag not in html_text.VOID:
            marked = tag in ("nav", "footer", "header", "aside", "form", "script", "style", "head") or dict(attrs).get("class") in ("ad", "sidebar", "comments", "cookie", "newsletter")
            self.open.append((tag, marked))

    def handle_endtag(self, tag):
        if tag in html_text.BLOCKS | html_text.CONTAINERS:
            self.blocks.append([])
        if tag in [t for t, _ in self.open]:
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if any(t in ("article", "main") for t, _ in self.open) and not any(marked for _, marked in self.open):
            self.blocks[-1].append(data)

    def text(self):
        return "\n".join(t for b in self.blocks if (t := " ".join("".join(b).split())))


def test_every_given_page_reads_as_a_slow_reader_has_it(spark):
    for sf in (SMALL, "/root/testdata/sf0.01"):
        rows = spark.read.parquet(f"{sf}/pages.parquet")
        got = {r.page_id: r.text for r in html_text.extract_text(rows).collect()}
        pages = rows.collect()
        assert len(got) == len(pages)
        plain = [p for p in pages if p.html and re.search("<article|<main", p.html)]
        assert len(plain) > 0.2 * len(pages)
        assert [p.page_id for p in plain if got[p.page_id] != SlowReader(p.html).text()] == []


def test_a_very_deep_page():
    assert html_text.extract("<div>" * 3000 + "deep" + "</div>" * 3000, None) == "deep"


# Quality


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs.select("doc_id", "text"), quality.train(docs, labels))
    joined = scored.join(labels, "doc_id").withColumn("held_out", quality.held_out(quality.F.col("doc_id"))).toPandas()
    out = joined[joined.held_out]
    assert len(out) > 80 and ((out.score >= 0.5) == (out.quality == 1)).mean() >= 0.97
    assert scored.filter("score < 0 or score > 1 or score is null").count() == 0


def test_labels_that_are_held_out_do_not_count(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    F = quality.F
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, flipped)
    assert (a.value == b.value).all() and a.base == b.base


def test_rows_that_share_a_labelled_id_count_once(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    seen, real = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(len(y)) or real(x, y))
    a = quality.train(docs, labels)
    b = quality.train(docs.unionByName(docs).unionByName(docs), labels.unionByName(labels))
    assert seen[0] == seen[1] and (a.value == b.value).all()


def test_quality_of_odd_inputs(spark, odd):
    none = spark.createDataFrame([(1, None, None), (None, 1, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    forest = quality.train(odd, none)
    clash = odd.withColumn("score", quality.F.lit("mine"))
    assert {r.score for r in quality.score(odd, forest).collect()} == {0.5}
    kept = quality.keep_good(clash, none)
    assert kept.columns == clash.columns and kept.count() == len(ODD)


def test_forest_agrees_with_a_walk_node_by_node():
    rng = np.random.default_rng(0)
    x = rng.random((400, len(quality.FEATURES)))
    y = (x[:, 3] + x[:, 7] > 1).astype(float)
    forest = quality.fit(x, y)
    bins = forest.binned(x)
    for i in range(0, 400, 37):
        total = forest.base
        for f, b, v in zip(forest.feature, forest.bin, forest.value, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + (bins[i, f[node]] > b[node])
            total += v[node - len(f)]
        assert forest.scores(x[i : i + 1])[0] == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((forest.scores(x) >= 0.5) == (y == 1)).mean() > 0.97
    order = rng.permutation(400)
    assert np.allclose(quality.fit(x[order], y[order]).scores(x), forest.scores(x))


# Decontamination


@pytest.fixture(scope="module")
def items():
    b = pd.read_parquet(f"{SMALL}/benchmark.parquet")
    return [(r.item_id, decontam.words_of(r.text)) for r in b.itertuples()]


def index_of(items):
    return decontam.ItemIndex([(i, w[: -(-2 * len(w) // 3)], w[-(-2 * len(w) // 3) :]) for i, w in items])


def test_wand_finds_what_full_scoring_finds(items):
    index, rng = index_of(items), random.Random(2)
    for _ in range(300):
        base = rng.choice(items)[1]
        terms = sorted({index.terms[w] for w in rng.sample(base, rng.randint(1, len(base))) + rng.sample(rng.choice(items)[1], 5)})
        full = Counter()
        for t in terms:
            for item, x in zip(index.postings[t].items, index.postings[t].impacts, strict=True):
                full[item] += x
        threshold = rng.choice([0.2, 0.5, 0.6, 0.9])
        want = {k: s for k, s in full.items() if s >= threshold - 1e-9}
        assert dict(index.search(terms, threshold=threshold)) == pytest.approx(want)
        lo = rng.randrange(len(items))
        assert set(dict(index.search(terms, lo, lo + 9, threshold))) == {k for k in want if lo <= k < lo + 9}


def test_leaks_match_containment(spark, items):
    docs = documents(spark)
    found = decontam.find_leaks(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()
    want = set()
    for r in docs.collect():
        body = " " + " ".join(decontam.words_of(r.text)) + " "
        want |= {(r.doc_id, i) for i, w in items if " " + " ".join(w) + " " in body}
    assert want and {(r.doc_id, r.item_id) for r in found} == want


def test_leaks_in_odd_places(spark, items):
    rng = random.Random(1)
    item, words = items[3]
    filler = lambda n: " ".join(f"zq{rng.randrange(10**6)}" for _ in range(n))
    rows = [(k, filler(k) + " " + " ".join(words).upper() + "!! " + filler(300)) for k in (0, 1, 63, 64, 65, 100, 5000)]
    rows += [(9001, " ".join(words[: len(words) // 3])), (9002, None), (9003, ""), (9004, filler(4000)), (9005, " ".join(w + "," for w in words)), (9005, " ".join(words))]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, item_id int, score int")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(999, None), (998, "...")], "item_id long, text string")
    got = decontam.find_leaks(docs, bench).collect()
    assert sorted(r.doc_id for r in got) == [0, 1, 63, 64, 65, 100, 5000, 9005, 9005] and {r.item_id for r in got} == {item}
    kept = decontam.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [9001, 9002, 9003, 9004]


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    docs, bench = documents(spark), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()}
    monkeypatch.setattr(decontam.indexes, "__defaults__", (16,))
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()} == whole


def test_blocks_of_items_give_the_same_scores(spark, items, monkeypatch):
    rng = random.Random(8)
    half = [(k, " ".join(w if rng.random() < p else f"zq{rng.randrange(999)}" for w in rng.choice(items)[1])) for k, p in enumerate([1, 0.9, 0.8, 0.7] * 30)]
    docs = spark.createDataFrame(half, "doc_id long, text string")
    long = " ".join(f"l{i}" for i in range(150))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(998, None), (999, long)], "item_id long, text string")
    whole = sorted(map(tuple, decontam.find_leaks(docs, bench).collect()))
    assert any(r[2] < 0.95 for r in whole)
    for size in (16, 50):
        monkeypatch.setattr(decontam.indexes, "__defaults__", (size,))
        assert sorted(map(tuple, decontam.find_leaks(docs, bench).collect())) == whole


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "string", "decimal(12,0)"])
def test_ids_of_any_type(spark, items, kind):
    docs = spark.createDataFrame([(1, "x " + " ".join(items[3][1])), (2, "none"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items[:100]], "item_id long, text string")
    F = decontam.F
    got = decontam.find_leaks(docs.withColumn("doc_id", F.col("doc_id").cast(kind)), bench.withColumn("item_id", F.col("item_id").cast(kind)))
    assert [(str(r.doc_id), str(r.item_id)) for r in got.collect()] == [("1", str(items[3][0]))] and dict(got.dtypes)["item_id"] == kind


def test_a_long_item_does_not_widen_the_windows_of_others(spark, items):
    rng = random.Random(1)
    filler = lambda n: " ".join(f"zq{rng.randrange(10**6)}" for _ in range(n))
    long = filler(700)
    docs = spark.createDataFrame([(1, filler(500) + " " + long + " " + filler(500)), (2, filler(90) + " " + " ".join(items[5][1]) + " " + filler(90))], "doc_id long, text string")
    bench = [(i, " ".join(w)) for i, w in items]
    with_long = decontam.find_leaks(docs, spark.createDataFrame([*bench, (999, long)], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in with_long} == {(1, 999), (2, items[5][0])}
    indexes = decontam.by_length([(i, w[:4], w[4:]) for i, w in [*items, (999, long.split())]])
    assert [x.step for x in indexes][0] == 64 and indexes[-1].step == 1024


# Licences


def test_prefix_filter_loses_no_match(spark):
    matcher = licenses.Matcher()
    lines = [line for r in documents(spark).collect() for line in r.text.split("\n")]
    lines += [t for texts in licenses.TEMPLATES.values() for t in texts] + ["licensed cc nc 4.0", "GNU version 3", "Mit und."]
    assert [x for x in lines if matcher.best(x)[0] >= matcher.threshold and not matcher.may_match(x)] == []
    for name, texts in licenses.TEMPLATES.items():
        for t in texts:
            assert matcher.scan("some words\n" + t + "\nmore words")[0] == name


def test_planted_notices_are_found(spark):
    rows = licenses.scan_files(documents(spark)).join(documents(spark).select("doc_id", "text"), "doc_id").toPandas()
    assert (rows.own_license.notna() == rows.text.str.contains("icense")).all()


@pytest.mark.parametrize(("text", "name"), [
    ("Copyright 2024 Jane Doe. Released under the MIT License.", "MIT"), ("Photo by Jane Doe, licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("This file is part of Foo. Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("Mine. Released under\nthe MIT\n\nLicense, as said.", "MIT"),
])
def test_notices_inside_running_text_are_found(text, name):
    matcher, rng = licenses.Matcher(), random.Random(3)
    filler = lambda n: " ".join(f"zq{rng.randrange(10**6)}" for _ in range(n))
    for around in (text, f"{filler(30)} {text} {filler(30)}", f"{filler(5000)} {text} {filler(5000)}"):
        assert matcher.scan(around)[:2] == (name, 1.0)


def test_word_windows_match_brute_force():
    matcher, rng = licenses.Matcher(), random.Random(5)
    pool = sorted(matcher.idf) + ["zq"] * 20
    for _ in range(40):
        k = rng.randrange(len(matcher.vectors))
        terms = [rng.choice(pool) for _ in range(rng.randrange(60))]
        notice = [w for w in matcher.vectors[k] if rng.random() < 0.9]
        terms = terms + notice + [rng.choice(pool) for _ in range(rng.randrange(60))]
        size = min(matcher.lengths[k], len(terms))
        cosine = lambda at: sum(x * matcher.vectors[k].get(w, 0.0) for w, x in matcher.vector(Counter(terms[at : at + size])).items())  # noqa: B023, E731
        scores = [cosine(at) for at in range(len(terms) - size + 1)]
        at = matcher.slide(terms, k)
        assert (at >= 0) == (max(scores) >= matcher.threshold) and (at < 0 or scores[at] == pytest.approx(max(scores)))


def test_windows_with_key_words_match_brute_force():
    matcher, rng = licenses.Matcher(), random.Random(7)
    pool = sorted(matcher.idf) + ["zq"] * 40
    for _ in range(120):
        k = rng.randrange(len(matcher.vectors))
        notice = [w for w in licenses.terms_of([t for texts in licenses.TEMPLATES.values() for t in texts][k]) if rng.random() < 0.93]
        terms = [rng.choice(pool) for _ in range(rng.randrange(40))] + notice + [rng.choice(pool) for _ in range(rng.randrange(40))]
        size = min(matcher.lengths[k], len(terms))

        def score(at, k=k, terms=terms, size=size):
            window = Counter(terms[at : at + size])
            if not matcher.keys[k] <= set(window) or matcher.others[k] & set(window):
                return 0.0
            return sum(x * matcher.vectors[k].get(w, 0.0) for w, x in matcher.vector(window).items())

        scores = [score(at) for at in range(len(terms) - size + 1)]
        at = matcher.slide(terms, k, True)
        assert (at >= 0) == (max(scores, default=0) >= matcher.threshold) and (at < 0 or scores[at] == pytest.approx(max(scores)))
        assert (max(scores, default=0) < matcher.threshold) or k in matcher.possible(terms)


RELATIVES = [
    ("This work is licensed under the GNU Lesser General Public License, version 2.1", "LGPL-2.1"), ("licensed under the GNU Lesser General Public License, version 3", "LGPL-3.0"), ("Licensed under CC BY-ND 4.0", "CC-BY-ND-4.0"), ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
    ("// SPDX-License-Identifier: AGPL-3.0", "AGPL-3.0"), (licenses._BSD_HEAD + "\n\n" + licenses._BSD_TAIL, "BSD-2-Clause"), (licenses._BSD_HEAD + "\n" + licenses._BSD_NAMES + "\n" + licenses._BSD_TAIL, "BSD-3-Clause"),
    ("You are free to use it: Licensed under CC BY 3.0.", None), ("licensed under the GNU General Public License, version 4", None), ("Released under the Apache License, Version 1.1", None), ("released under pressure, the license of the poet", None),
]


@pytest.mark.parametrize(("text", "name"), RELATIVES)
def test_relatives_are_told_apart(text, name):
    rng = random.Random(3)
    filler = " ".join(f"zq{rng.randrange(10**6)}" for _ in range(40))
    for around in (text, f"{filler} {text} {filler}"):
        assert licenses.Matcher().scan(around)[0] == name


def test_edited_notices_are_found_at_every_place():
    """Recall against brute force over all spans: a template with words dropped or changed, anywhere in a long text."""
    matcher, rng, texts = licenses.Matcher(), random.Random(12), [(n, t) for n, ts in licenses.TEMPLATES.items() for t in ts]
    found = want = 0
    for _ in range(150):
        name, t = rng.choice(texts)
        words = t.split()
        words = [w if rng.random() < 0.95 else f"zq{rng.randrange(99)}" for w in words]
        text = " ".join([f"zq{rng.randrange(10**6)}" for _ in range(rng.randrange(300))] + words + [f"zq{rng.randrange(10**6)}" for _ in range(rng.randrange(300))])
        terms = licenses.terms_of(text)
        reach = 0.0
        for k, other in enumerate(matcher.names):
            if other == name:
                for at in range(max(1, len(terms) - matcher.lengths[k] + 1)):
                    window = Counter(terms[at : at + matcher.lengths[k]])
                    if matcher.keys[k] <= set(window) and not matcher.others[k] & set(window) and sum(matcher.vectors[k].get(w, 0) ** 2 for w in window) > 0.5:
                        reach = max(reach, sum(x * matcher.vectors[k].get(w, 0.0) for w, x in matcher.vector(window).items()))
        if reach >= matcher.threshold:
            want += 1
            found += matcher.scan(text)[0] == name
    assert want > 100 and found >= 0.95 * want


def test_columns_named_as_the_results_pass_through(spark):
    files = spark.createDataFrame([("LICENSE", "Released under the MIT License.", "p", "mine", "x", 1), ("a/b.txt", "q", "p2", "mine2", "y", 2)], "path string, text string, passage string, license string, own_license string, inherited_from int")
    got = {r.path: r for r in licenses.inherit(licenses.scan_files(files)).collect()}
    assert got["a/b.txt"].license == "mine2" and got["a/b.txt"]["license_"] == "MIT" and got["a/b.txt"]["inherited_from_"] == "LICENSE" and got["a/b.txt"].inherited_from == 2
    assert got["LICENSE"].passage == "p" and got["LICENSE"]["passage_"] == "Released under the MIT License" and got["LICENSE"].own_license == "x" and got["LICENSE"]["own_license_"] == "MIT"


def test_inheritance_goes_to_the_nearest_directory(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [("LICENSE", mit), ("a/b/COPYING", gpl), ("a/x.txt", "q"), ("a/b/c/d.txt", "q"), ("z.txt", ""), ("a/b/own.txt", mit), (None, "q"), ("a/b/c/d.txt", "q"), ("a/bb/y", None), ("n/LICENSE", "nothing here")]
    files = spark.createDataFrame([(p, t, "mine") for p, t in rows], "path string, text string, license_note string")
    got = {(r.path, r.license, r.inherited_from) for r in licenses.inherit(licenses.scan_files(files)).collect()}
    assert got == {
        ("LICENSE", "MIT", None), ("a/b/COPYING", "GPL-3.0", None), ("a/x.txt", "MIT", "LICENSE"), ("a/b/c/d.txt", "GPL-3.0", "a/b/COPYING"), ("z.txt", "MIT", "LICENSE"),
        ("a/b/own.txt", "MIT", None), (None, None, None), ("a/bb/y", "MIT", "LICENSE"), ("n/LICENSE", "MIT", "LICENSE"),
    }


def test_odd_documents_go_through(spark, odd):
    assert licenses.scan_files(odd).filter("own_license is not null").count() == 0
    assert decontam.find_leaks(odd, spark.read.parquet(f"{SMALL}/benchmark.parquet")).count() == 0
