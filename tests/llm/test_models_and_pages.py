"""Toxicity, tokens and pages: edges, held-out accuracy, round trips, the pipeline."""

import html
import re

import pytest

import corpus_pipeline
from skywave.llm import html_extraction, queries, sentencepiece_dropout, toxicity
from .conftest import SF_TINY, edge_rows


# ---------------------------------------------------------------- toxicity
def test_grammar_reads_clauses():
    lex = toxicity.Lexicon({"idiot": 5.0, "scumm*": 4.0})
    score = lambda t: lex.figures(t)[0]
    plain, target = score("an idiot here"), score("you idiot here")
    assert 0 < plain < target
    assert score("you are not an idiot") < target                 # negation
    assert score('they said "idiot" there') < score("they idiot there")
    assert score("kill the process") == 0 < score("i will kill you")   # a threat needs a target
    assert score("scummily done") > 0 and score("") == 0 and lex.figures("clean words only") == (0.0, 0.0, 0.0)
    assert lex.figures("idiot. idiot scummily")[2] > lex.figures("idiot. idiot")[2]


def test_compose_is_the_product():
    g = toxicity.GRAMMAR
    states = {s for s, _ in g}
    assert len(states) == 2 * 4 * 3 and len(g) == len(states) * 7 and {n for n, _ in g.values()} <= states


def test_toxicity_learns_and_scores(spark, edges, empty):
    import random
    r = random.Random(1)
    rows = []
    for i in range(600):
        bad = i % 4 == 0
        words = [r.choice("alpha beta gamma delta you are not".split()) for _ in range(40)]
        for _ in range(3 * bad):
            words[r.randrange(40)] = r.choice(["grunkel", "blorfix", "snarkle"])
        rows.append((i, " ".join(words) + ".", int(bad)))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], 1, x[2]) for x in rows] + [(1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.scored(docs, model).collect()
    held = [x for x in got if x.held_out]
    assert 60 < len(held) < 180 and all(x.predicted == (x.doc_id % 4 == 0) for x in held)
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got)
    out = toxicity.scored(edges, model).collect()
    assert len(out) == len(edge_rows()) and not any(x.predicted for x in out)
    assert toxicity.clean(edges, model).columns == edges.columns and toxicity.clean(edges, model).count() == len(edge_rows())
    assert toxicity.scored(empty, model).count() == 0
    untaught = toxicity.fit(docs, labels.limit(0))
    assert not any(x.predicted for x in toxicity.scored(docs, untaught).collect())


def test_thinned_sample_keeps_the_prior(spark):
    """One toxic row in ten, some clean rows with one of its words: a sample of equal parts fits the curve of all rows."""
    import random
    r = random.Random(2)
    rows = []
    for i in range(6000):
        bad = i % 10 == 0
        words = [r.choice("alpha beta gamma delta".split()) for _ in range(30)]
        for _ in range(r.choice([1, 1, 2, 3]) if bad else r.random() < 0.08):
            words[r.randrange(30)] = r.choice(["grunkel", "blorfix"])
        rows.append((i, " ".join(words) + ".", int(bad)))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string").persist()
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int").persist()
    full, thin = toxicity.fit(docs, labels), toxicity.fit(docs, labels, rows=900)
    assert abs(full.curve_at((0.0, 0.0, 0.0)) - thin.curve_at((0.0, 0.0, 0.0))) < 0.02
    one = "alpha grunkel beta."
    assert full.score(one) >= 0.3 and abs(thin.score(one) - full.score(one)) < 0.15


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    labels = spark.read.parquet(f"{SF_TINY}/labels.parquet")
    from pyspark.sql import functions as F
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, turned)
    assert a.lexicon.words == b.lexicon.words and list(a.curve) == list(b.curve)


# ---------------------------------------------------------------- tokens
def test_dropout_zero_is_the_models_own():
    import sentencepiece
    v = sentencepiece_dropout.Vocabulary()
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_dropout.MODEL)
    e = sentencepiece_dropout.Encoder(v, 0.0)
    for t in ["Hello world, it's  fine.", "a\n\n\tb", "héé 漢字😀 ", "x" * 300, "The quick brown fox's 12345.67"] + [t for _, t, *_ in edge_rows() if t and "▁" not in t]:
        assert e.encode(t) == sp.encode(t)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_round_trip(dropout):
    v = sentencepiece_dropout.Vocabulary()
    e = sentencepiece_dropout.Encoder(v, dropout)
    for t in [t or "" for _, t, *_ in edge_rows()] + ["▁", " ▁ ▁▁ a▁b", " x�"]:
        for key in (0, -3):
            assert v.decode(e.encode(t, key)) == t


def test_dropout_varies_and_repeats():
    v = sentencepiece_dropout.Vocabulary()
    t = "segmentation varies with the key of tokenization " * 5
    a, b = sentencepiece_dropout.Encoder(v, 0.3), sentencepiece_dropout.Encoder(v, 0.3)
    assert a.encode(t, 1) == b.encode(t, 1) != a.encode(t, 2)
    assert sentencepiece_dropout.Encoder(v, 0.3, seed=5).encode(t, 1) != a.encode(t, 1)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6])
def test_units_are_cut_anew_at_each_place(dropout):
    """The remembered agendas and those of many units at once against one unit's heap."""
    import numpy as np
    v = sentencepiece_dropout.Vocabulary()
    texts = [(t or "", (i or 0) * 77 - 5) for i, t, *_ in edge_rows()] + [("héé漢字 ▁ab segmentation, aaaaaaaaaaaaaaaa     x ", 3), ("internationalization " * 400, 4)]
    e = sentencepiece_dropout.Encoder(v, dropout)
    for _ in range(2):                                    # with units anew, then remembered
        for (t, key), got in zip(texts, e.batch(texts)):
            units = sentencepiece_dropout._UNIT.findall(" " + t) if t else []
            keys = e.keys(np.full(len(units), key & 0xFFFFFFFFFFFFFFFF, np.uint64), np.arange(len(units)))
            assert got == b"".join(e.agenda(u, k) for u, k in zip(units, keys))
    cuts = {e.agenda(" internationalization", k) for k in e.keys(np.full(400, 4, np.uint64), np.arange(400))}
    assert len(cuts) == 1 if not dropout else len(cuts) > 8


def test_encoding_edges(spark, edges, empty):
    out = sentencepiece_dropout.encoded(edges)
    rows = out.collect()
    assert len(rows) == len(edge_rows()) and all(r.lossless and r.n_pieces == len(r.ids) for r in rows)
    back = {r.doc_id: r.text for r in sentencepiece_dropout.decoded(out).collect()}
    assert back == {i: t or "" for i, t, *_ in edge_rows()}
    assert sentencepiece_dropout.encoded(empty).count() == 0


# ---------------------------------------------------------------- pages
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x}</style><script>var a="</p><article>no</article>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li></ul></nav><header>Site</header><div class="ad">Buy</div><div class="cookie notice">We use</div>
<article><h1>Title &amp; more</h1><p>First <b>bold</b>word &#8212; a&nbsp;b &lt;p&gt;</p><p>Second<br>line<aside>Side</aside><p>Unclosed
 lines<!-- hidden --> go on</p><form>Name</form><ul><li>one</li><li>two</li></ul></article>
<section class="comments"><p>Reader says</p></section><footer>Foot</footer></body></html>"""


def test_extract_article():
    want = "Title & more\nFirst boldword — a b <p>\nSecond\nline\nUnclosed lines go on\none\ntwo"
    assert html_extraction.extract(PAGE) == want
    assert html_extraction.extract(PAGE, "html/body/article") == want
    assert html_extraction.extract(PAGE[:PAGE.index("<ul><li>one")], "html/body/article").startswith("Title & more")
    assert html_extraction.extract(None) == html_extraction.extract("") == html_extraction.extract("<p></p>") == ""
    assert html_extraction.extract("plain text only") == "plain text only"
    assert html_extraction.extract("<article><p>a<p>b") == "a\nb"


def test_template_without_article(spark, empty):
    """No article element: the class of all pages gives the template, its constant texts go, the slots stay."""
    page = lambda i: (f"<html><body><div class='top'><p>Welcome to us</p><a href='/'>go</a></div><div class='box'><p>Always here</p><p>Story {i} tells of {i * 7} things "  # noqa: E731
                      f"and many more words in it.</p><p>Part two of {i}.</p></div><div class='foot'><p>Contact</p></div></body></html>")
    rows = [(i, f"http://h{i % 2}.example/{i}", page(i)) for i in range(40)] + [(40, None, None), (41, "http://solo.example/", PAGE), (41, "http://solo.example/", PAGE), (None, "x", "<p>y</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = html_extraction.extracted(pages).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows)
    assert by[3].text == "Story 3 tells of 21 things and many more words in it.\nPart two of 3."
    assert by[40].text == "" and by[41].text.startswith("Title & more") and all(r.n_chars == len(r.text) for r in got)
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extraction.extracted(none).count() == 0


def _texts(spark, pages: list, host: str = "h") -> list[str]:
    rows = [(i, f"http://{host}.example/{i}", p) for i, p in enumerate(pages)]
    got = html_extraction.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


def test_template_inside_article(spark):
    """What all pages of a host have inside the article is the template's; a host with few pages is read by tag names."""
    page = lambda i: (f"<body><article><h1>Title {i}</h1><p>Story {i}.</p><div class='author-box'><p>Written by our staff</p></div>"  # noqa: E731
                      "<div class='sharebar'><a href='/s'>Send it on</a></div></article></body>")
    assert _texts(spark, [page(i) for i in range(20)]) == [f"Title {i}\nStory {i}." for i in range(20)]
    assert _texts(spark, [page(i) for i in range(4)]) == [f"Title {i}\nStory {i}.\nWritten by our staff\nSend it on" for i in range(4)]
    assert _texts(spark, [page(1)] * 12) == ["Title 1\nStory 1.\nWritten by our staff\nSend it on"] * 12


def test_template_despite_odd_pages(spark):
    """Null, empty, cut off and error pages of the host and a second template leave the template's texts known."""
    page = lambda i: (f"<html><body><div class='top'><p>Welcome to us</p></div><div class='box'><p>Always here</p><p>Story {i} tells of many things.</p></div>"  # noqa: E731
                      "<div class='foot'><p>Contact</p></div></body></html>")
    odd = [None, "", "<html><body><h2>Error</h2></body></html>", page(0)[:page(0).index("Always")]]
    good = [page(i) for i in range(40)]
    want = [f"Story {i} tells of many things." for i in range(40)]
    assert _texts(spark, good + odd)[:40] == want
    assert _texts(spark, good + odd)[40:42] == ["", ""]
    other = [f"<html><body><div class='new'><p>Fact {i}.</p></div></body></html>" for i in range(26)]
    assert _texts(spark, good + other)[:40] == want and _texts(spark, good + other)[40:] == [f"Fact {i}." for i in range(26)]


def test_wrappers_are_not_boilerplate():
    """Class names of layouts skip nothing, and no element with the article or most of the text is skipped."""
    inner = "<article><p>The story.</p></article><div class='comments'><article><p>A reader says a lot about the story.</p></article></div><div class='sidebar'><p>Aside</p></div>"
    for name in ("layout with-sidebar", "has-sidebar", "content no-sidebar", "content-sidebar-wrap", "sidebar", "siteHeader"):
        assert html_extraction.extract(f"<body><div class='{name}'>{inner}</div></body>") == "The story.", name
    plain = "<body><div class='content-sidebar-wrap'><p>A story without any article element.</p><div class='comments'><p>Reader</p></div></div><div class='menu'><p>Go</p></div></body>"
    assert html_extraction.extract(plain) == "A story without any article element."
    assert html_extraction.extract("<body><div id='x'><p>Short.</p></div><div class='comments'><p>Much longer than the story itself.</p></div></body>") == "Short."
    assert html_extraction.extract("<p>a <span class='ad'>buy</span> b</p>") == "a b"


def test_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{SF_TINY}/pages.parquet").toPandas()
    got = {r.page_id: r.text for r in queries.op1_html_extraction(spark, SF_TINY).collect()}
    for r in pages.itertuples():
        body = re.search("<article>(.*?)(</article>|$)", r.html or "", re.S)
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:p|h1|br)>", body[1])] if body else []
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark):
    """Each stage against the plain result of its own input."""
    from .test_text_operators import ITEMS, brute_components, brute_hits  # noqa: F401
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet").persist()
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_TINY}/benchmark.parquet").collect()]
    model = toxicity.fit(docs, spark.read.parquet(f"{SF_TINY}/labels.parquet"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    rows = {i: t for i, t in rows.items() if model.score(t) < 0.5}
    first: dict[str, int] = {}
    for i in sorted(rows):
        first.setdefault(re.sub(r"[ \t-\r]+", " ", rows[i] or ""), i)
    rows = {i: rows[i] for i in first.values()}
    rows = {i: rows[i] for i, (_, c) in brute_components(list(rows.items())).items() if i == c}
    got = corpus_pipeline.run(spark, SF_TINY).collect()
    want = {}
    for i, t in rows.items():
        n, hit, _ = brute_hits(t, bench) if any(w in t for w in ("the", "")) else (0, 0, [])
        if hit <= 0.5 * n:
            want[i] = hit
    assert {r.doc_id for r in got} == set(want) and all(r.lossless for r in got)
    v = sentencepiece_dropout.Vocabulary()
    for r in got:
        assert (v.decode(r.ids) == rows[r.doc_id]) == (want[r.doc_id] == 0)


def test_pipeline_keeps_columns(spark, empty, edges):
    import pyspark.sql.functions as F
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty.withColumn("extra", F.lit(1)), SF_TINY).columns == [*empty.columns, "extra"], name
        assert stage(spark, edges, SF_TINY).columns == edges.columns


# ---------------------------------------------------------------- registered SQL
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_their_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_TINY}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF_TINY)
    want = con.execute(queries.ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, want.fetchall()))
