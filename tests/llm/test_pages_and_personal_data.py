"""HTML extraction, personal data, and the pipeline as a whole."""

from __future__ import annotations

import random
import re
from collections import Counter

import __spark_entry__ as entry_points
import corpus
import corpus_pipeline
import numpy as np
from bazaarlens.llm import bpe, decontaminate, html_template, line_windows, personal, quality, simhash

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        luhn = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
        if 13 <= len(digits) <= 19 and luhn % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]


def test_base_spans_against_the_patterns():
    chosen = random.Random(2)
    parts = ["a", "@", ".", "1", "25", "300", "-", " ", "+", "(", ")", "é", "x.y", "4111111111111111", "b-c", "%", "٣", "\n"]
    for _ in range(20000):
        text = "".join(chosen.choice(parts) for _ in range(chosen.randrange(25)))
        assert personal.base_spans(text) == brute_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 4000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "1 " * 4000):
        personal.base_spans(text)


def fitted():
    chosen = random.Random(8)
    texts = []
    for i in range(250):
        phone = f"+1 ({chosen.randrange(200, 999)}) 555-{chosen.randrange(1000, 9999)}"
        address = ".".join(str(chosen.randrange(1, 255)) for _ in range(4))
        words = corpus.sentence(i, 30).split()
        words.insert(5, phone)
        words.insert(12, f"mail{i}@host{i % 7}.example.com")
        words.insert(20, address)
        if i % 3 == 0:
            words.insert(25, phone)
        words += ["version", "3.", f"{chosen.randrange(100)}"]
        texts.append(" ".join(words))
    return personal.fit(texts)


def test_links_carry_labels_across_a_document():
    model = fitted()
    graph = personal.Graph()
    text = "call +1 (456) 555-2186 today. Later some words and 555-2186 again, but 731-9082 is not known"
    graph.add(0, text)
    assert graph.skip
    chain, skip = (np.array(p, dtype=np.int64).reshape(-1, 2) for p in (graph.chain, graph.skip))
    with_links, _, _ = model.beliefs(graph.features(), chain, skip)
    without, _, _ = model.beliefs(graph.features(), chain, skip[:0])
    tokens = [text[a:b] for _, a, b in graph.spans]
    repeated, phone = len(tokens) - 1 - tokens[::-1].index("555-2186"), personal.KINDS.index("phone") + 1
    assert with_links[repeated, phone] > without[repeated, phone]
    assert model.skip[phone, phone] > 0


def test_added_spans_touch_no_base_span():
    model = fitted()
    text = "call +1 (456) 555-2186 190.10.10.10 now or mail me@host.example.com; (456) 555-2186"
    base = personal.base_spans(text)
    (added,) = personal.added_spans(model, [text], [base])
    assert all(b <= s or e <= a for _, a, b in base for _, s, e in added)


def test_exact_messages_on_a_tree():
    """Without loops the messages give the exact marginals."""
    random_numbers = np.random.default_rng(1)
    size, labels = 4, personal.LABELS
    model = personal.SkipChainField(*(random_numbers.standard_normal(s) for s in ((3, labels), (labels, labels), (labels, labels))))
    features, chain, skip = random_numbers.standard_normal((size, 3)), np.array([[0, 1], [1, 2]]), np.array([[0, 3]])
    personal_rounds, personal._ROUNDS = personal._ROUNDS, 60
    found, _, _ = model.beliefs(features, chain, skip)
    personal._ROUNDS = personal_rounds
    exact = np.zeros((size, labels))
    unary = features @ model.nodes
    for assignment in np.ndindex(*[labels] * size):
        energy = sum(unary[i, a] for i, a in enumerate(assignment))
        energy += sum(model.chain[assignment[a], assignment[b]] for a, b in chain) + model.skip[assignment[0], assignment[3]]
        for i, a in enumerate(assignment):
            exact[i, a] += np.exp(energy)
    assert np.allclose(found, exact / exact.sum(axis=1, keepdims=True), atol=1e-6)


def test_personal_data_rows(spark):
    rows = corpus.awkward_rows() + [(50, "mail a@b.co, ip 1.2.3.4 card 4111 1111 1111 1111 tel +49 (30) 1234567", "en")]
    got = personal.find_personal_data(corpus.documents(spark, rows)).collect()
    assert len(got) == len(rows)
    row = next(r for r in got if r["doc_id"] == 50)
    assert [row[f"n_{k}"] for k in personal.KINDS] == [1, 1, 1, 1]
    assert row["spans"].startswith("email:5:11,ip:16:23,card:29:48,phone:53:69")
    assert personal.find_personal_data(corpus.documents(spark).limit(0)).count() == 0


PAGE = (
    '<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var x="</p><article>";</script></head><body>'
    '<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>'
    '{open}<h1>Title {n} &amp; more</h1><p>First  <b>bold</b>\n text {n}<p>Second &lt;b&gt; &copy {n}<br>line'
    '<div class="ad">Buy</div><form><input>Sign up</form><ul><li>one<li>two {n}</ul><aside>Side</aside>'
    '<div id="comments"><p>Reader says</p></div>{close}<footer>&copy; host</footer></body></html>'
)


def wanted(n):
    return f"Title {n} & more\nFirst bold text {n}\nSecond <b> © {n} line\none\ntwo {n}"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")


def test_article_of_each_host(spark):
    rows = []
    for n in range(12):
        rows.append((n, f"https://A.example/{n}", PAGE.format(n=n, open="<article>", close="</article>")))
        rows.append((100 + n, f"http://user@b.example/{n}", PAGE.format(n=n, open='<div class="wrap"><div class="body">', close="</div></div>")))
        rows.append((200 + n, f"http://c.example/{n}?q", PAGE.format(n=n, open='<main class="m">', close="")))
    rows += [(300, None, "plain words"), (301, "http://d.example", None), (302, "x", ""), (None, None, "<p>a</p>"), (302, "x", "")]
    got = {}
    for r in html_template.extract(pages(spark, rows)).collect():
        got.setdefault(r["page_id"], []).append((r["text"], r["n_chars"]))
    for n in range(12):
        for start in (0, 100, 200):
            assert got[start + n] == [(wanted(n), len(wanted(n)))]
    assert got[300] == [("plain words", 11)] and got[301] == [("", 0)] and got[302] == [("", 0)] * 2 and got[None] == [("a", 1)]
    assert html_template.extract(pages(spark, rows).limit(0)).count() == 0


def test_broken_markup_does_not_crash():
    for text in ("<", "<p", "<!-- open", "<script>never closed", "</p></div>", "<p a='", "a < b > c", "<p>" * 3000 + "x", "<div>" * 3000 + "deep", "&#0;&#xD800;&am"):
        html_template.main_text(text, None)
    assert html_template.main_text("<div>" * 3000 + "deep", None) == "deep"


def test_given_pages_give_their_articles(spark):
    import html

    frame = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_template.extract(frame).collect()}
    for row in frame.collect():
        article = re.search(r"<article>(.*?)</article>", row["html"], re.DOTALL)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert got[row["page_id"]] == "\n".join(p for p in parts if p)


def test_pipeline_is_its_stages_one_after_another(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    expected = [quality.keep_good, line_windows.dedup_lines, simhash.keep_one, lambda d: decontaminate.clean(d, benchmark)]
    for (_, stage), plain in zip(corpus_pipeline.STAGES, expected, strict=False):
        before = Counter(map(tuple, docs.collect()))
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns
        rows = Counter(map(tuple, after.collect()))
        assert rows == Counter(map(tuple, plain(docs).collect()))
        if stage is not corpus_pipeline.line_dedup:
            assert not rows - before
        docs = spark.createDataFrame(after.collect(), docs.schema)
    want = {r["doc_id"]: r["ids_sha256"] for r in bpe.encode(docs).collect()}
    assert {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, sf).collect()} == want


def test_eleven_queries_are_registered():
    names = entry_points.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def texts_by_page(spark, rows):
    return {r["page_id"]: r["text"] for r in html_template.extract(pages(spark, rows)).collect()}


def test_template_text_without_a_listed_name_is_dropped(spark):
    page = "<body><div>Welcome to our pages</div><div class=wrap><p>First {n} words</p><p>Read more in our magazine</p><p>Last {n}</p></div></body>"
    rows = [(n, f"http://notices.example/{n}", page.format(n=n)) for n in range(8)]
    # Copies of an article are no template.
    copy = "<body><div class=wrap><p>The same article again</p></div><aside>{n}</aside></body>"
    rows += [(100 + n, f"http://copies.example/{n}", copy.format(n=n)) for n in range(8)]
    got = texts_by_page(spark, rows)
    for n in range(8):
        assert got[n] == f"First {n} words\nLast {n}"
        assert got[100 + n] == "The same article again"


def test_slot_holds_all_varying_text_of_each_layout(spark):
    layouts = [
        "<div class=wrap><h1>Title {n}</h1><div class=lead>A long lead text {n}</div><div class=body>The body text of page {n}</div></div>",
        "<article><h1>Title {n}</h1><article class=teaser>A long lead text {n}</article><p>The body text of page {n}</p></article>",
        "<section><p>Title {n}</p><p>A long lead text {n}</p></section><section><p>The body text of page {n}</p></section>",
    ]
    rows = [(n, f"http://h.example/{n}", f"<body><div>Our house</div>{layouts[n % 3].format(n=n)}</body>") for n in range(18)]
    rows.append((99, "http://one.example/", "<article>Teaser</article><div>The whole text of the page</div>"))
    got = texts_by_page(spark, rows)
    for n in range(18):
        assert got[n] == f"Title {n}\nA long lead text {n}\nThe body text of page {n}"
    assert got[99] == "Teaser\nThe whole text of the page"


def test_names_alone_make_no_furniture(spark):
    layouts = [
        "<body class='has-sidebar'><main class='content with-sidebar'><h1>Title {n}</h1><p>The body text of page {n}</p></main></body>",
        "<article class='post share-enabled'><h1>Title {n}</h1><p>The body text of page {n}</p></article><div class=ad>Buy {n}</div>",
        "<h1>Title {n}</h1><div id='search-result-12'><p>The body text of page {n}</p></div><footer>f</footer>",
        "<h1>Title {n}</h1><div id='search-result-1'>The body</div><div id='search-result-2'>text of page {n}</div>",
        "<div class=cookie-notice>Ok {n}?</div><div class=text><h1>Title {n}</h1><div>The body text of page {n}</div></div>",
    ]
    rows = [(10 * i + n, f"http://h{i}.example/{n}", layout.format(n=n)) for i, layout in enumerate(layouts) for n in range(1 + i % 2 * 5)]
    for page, text in texts_by_page(spark, rows).items():
        n = page % 10
        assert " ".join(text.split()) == f"Title {n} The body text of page {n}"


def test_labels_agree_however_often_a_token_comes():
    model = fitted()
    text = "call +1 (456) 555-2186 today. " + "Later some words and 555-2186 again. " * 40
    graph = personal.Graph()
    graph.add(0, text)
    chain, skip = (np.array(p, dtype=np.int64).reshape(-1, 2) for p in (graph.chain, graph.skip))
    given = personal.gold_labels(graph, [personal.base_spans(text)])
    found, _, _ = model.beliefs(graph.features(), chain, skip, given)
    later = found[[text[a:b] == "555-2186" and not given[i] for i, (_, a, b) in enumerate(graph.spans)]]
    assert len(later) == 40 and np.allclose(later, later[0], atol=1e-4)
    phone = personal.KINDS.index("phone") + 1
    assert (later.argmax(axis=1) == phone).all()
    (added,) = personal.added_spans(model, [text], [personal.base_spans(text)])
    assert len([s for s in added if s[0] == "phone"]) == 40
