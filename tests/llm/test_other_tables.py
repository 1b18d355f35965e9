"""Toxicity, pages, conversations, embeddings and the pipeline against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from test_documents import plain_fingerprint, plain_groups, plain_spans

from scholion.llm import chat, html_text, lattice, packing, toxicity
from scholion.llm import queries as Q

# ---------------------------------------------------------------- toxicity


def test_grades(spark):
    clean = [(i, f"calm words number{i} here", 0) for i in range(300)]
    mild = [(1000 + i, f"some nasty words number{i}", 1) for i in range(60)]
    harsh = [(2000 + i, f"nasty vile rotten awful foul mean number{i} hateful crude", 1) for i in range(60)]
    rows = clean + mild + harsh
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(9000, None, "x"), (9001, "", "x")], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    got = {r.doc_id: r for r in toxicity.grade_documents(docs, model).collect()}
    assert all(got[i].toxic == (y == 1) for i, _, y in rows)
    assert min(got[i].severity for i, _, _ in harsh) > max(got[i].severity for i, _, _ in mild)
    assert not got[9000].toxic and not got[9001].toxic and len(got) == len(rows) + 2


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert not model.weights and toxicity.grade_documents(docs, model).count() == 0


def test_held_out_english(spark):
    """Labels of other languages in this small table hold no common words; English ones do."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels.where("doc_id % 4 > 0"))
    held = labels.where("doc_id % 4 = 0").withColumnRenamed("toxic", "label")
    rows = toxicity.grade_documents(docs, model, ("lang",)).join(held, "doc_id").where("lang = 'en'").collect()
    assert sum(r.toxic == (r.label == 1) for r in rows) >= 0.95 * len(rows)


# ---------------------------------------------------------------- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head>
<body><header class="site"><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><!-- <p>hidden</p> -->
<div class="layout"><aside class="sidebar"><p>Side text that goes on for a while.</p></aside>
<article class="post-17"><header><h1>Head &amp; line</h1></header>
<p>First  <b>bold</b>
line<br>goes on &mdash; caf&eacute;.<p>Second<sup>2</sup>
<div class="ad">Buy!</div><ul><li>one<li>two</ul><blockquote><p>Quote</p></blockquote>
<form><input name=q><button>Go</button></form>
<table><tr><td>a</td><td>b</td></tr></table><pre>x
  y</pre>
<section class="comments"><p>First!</p></section></article></div>
<footer>&copy; 2024</footer></body></html>"""
TEXT = "Head & line\nFirst bold line goes on — café.\nSecond2\none\ntwo\nQuote\na\nb\nx y"


def test_article_of_a_page():
    text, path = html_text.main_text(PAGE, None)
    assert text == TEXT
    assert path == "html>body>div.layout>article.post-#"


def test_pages(spark):
    bare = "<p>Only a paragraph &lt;b&gt;.</p>"
    divs = "<html><body><div id=menu><a href=x>m</a></div><div class='c c9'><p>%s</p><p>More of it.</p></div><div class=foot>f</div></body></html>"
    rows = [
        (1, "http://A.example:80/x", PAGE),
        (2, None, None),
        (3, "", ""),
        (4, "http://b.example/1", divs % ("Words of one page, many of them. " * 9)),
        (5, "http://b.example/2", divs % "Short"),
        (6, "http://b.example/3", "<div class='c c9'>Short too</div><div class=x>longer than the container that won by votes</div>"),
        (7, "mailto:x", bare),
        (8, "http://c.example", "<html><nav>only menus</nav></html>"),
        (9, "http://c.example", "no markup &amp; nothing"),
        (9, "http://c.example", "no markup &amp; nothing"),
        (10, "//d.example", "<article><p>a</article><article><p>b</article>"),
        (11, "http://e.example", "<div>" * 3000 + "<p>deep<p>end"),
    ]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, path string")
    got = defaultdict(list)
    for r in html_text.extract_pages(docs).collect():
        got[r.page_id].append(r.text)
    assert got[1] == [TEXT] and got[2] == got[3] == got[8] == [""]
    assert got[5] == ["Short\nMore of it."]
    assert got[7] == ["Only a paragraph <b>."] and got[9] == ["no markup & nothing"] * 2
    assert got[10] == ["a\nb"]
    assert got[11] == ["deep\nend"]
    assert html_text.extract_pages(docs.limit(0)).count() == 0


def test_text_beside_the_container_is_kept():
    lead = "<div class=lead><h1>Headline</h1><p>The lead tells what this is about.</p></div>"
    body = "<div class=body><p>%s</p><p>Last.</p></div>" % ("Words of the body. " * 40).strip()
    more = "<div class=more>Bare<br>words.</div>"
    want = "Headline\nThe lead tells what this is about.\n" + ("Words of the body. " * 40).strip() + "\nLast.\nBare words."
    links = "<div class=x><p>Read on:</p><ul><li><a href=/1>One more page</a><li><a href=/2>Another page</a></ul></div>"
    foot = "<div class=foot>Imprint</div><div class=end>&copy; 2024 Somebody <a href=/t>Terms</a></div>"
    page = f"<html><body><div class=menu>Menu</div><div class=wrap>{links}{lead}{body}{more}</div>{links}{foot}</body></html>"
    for path in (None, "html>body>div.wrap>div.body", "html>body"):
        text, found = html_text.main_text(page, path)
        if path != "html>body":
            assert (text, found) == (want, "html>body>div.wrap")
        assert want in text
    bare = f"<body>a<br>b {lead}{body}<a href=/1>Home</a> | <a href=/2>Abroad</a></body>"
    assert html_text.main_text(bare, None)[0] == "a b\n" + want.removesuffix("\nBare words.")
    linked = f"<body><div><h2><a href=/self>Headline</a></h2></div>{body}"
    assert html_text.main_text(linked, None)[0].startswith("Headline\nWords")
    assert html_text.main_text(f"<body>{body}" + "<div>" * 3000 + "<p>deep", None)[0].endswith("Last.\ndeep")
    alone = f"<body>{body}{links}<p>&nbsp;</p></body>"
    assert html_text.main_text(alone, None)[1] == "body>div.body"


def test_host_path_leaves_no_text_out(spark):
    words = ("Words of the body. " * 12).strip()
    most = f"<body><article><div class=text><p>{words}</p></div></article></body>"
    nested = most.replace("<article>", "<div>").replace("</article>", "</div>")  # votes for div.text
    few = "<body><%s><h1>Head</h1><div class=text><p>{0}</p></div><p>Not in the text block.</p></%s></body>".replace("{0}", words)
    path = "body>article>div.text"
    for page, won in ((few % ("article", "article"), path), (few % ("div", "div"), "body>div>div.text")):
        assert html_text.main_text(page, won)[0] == f"Head\n{words}\nNot in the text block."
    links = "<ul><li><a href=/1>One more page</a><li><a href=/2>Another page</a></ul>"
    assert html_text.main_text(most.replace("<article>", "<article>" + links), path) == (words, path)
    apart = f"<body><article><p>{words}</p></article><div class=text><p>{words} Other.</p></div></body>"
    assert html_text.main_text(apart, "body>div.text") == (f"{words}\n{words} Other.", "body")
    assert html_text.main_text(apart, "body") == (f"{words}\n{words} Other.", "body")
    rows = [(i, "http://a.example/", nested) for i in range(3)] + [(3, "http://a.example/", few % ("div", "div"))]
    got = html_text.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).where("page_id = 3").first()
    assert got.text == f"Head\n{words}\nNot in the text block."


WORDS = "Words of the body, many of them. " * 12
#: Elements of an article whose names hold a word of menus and the like, and others that are such.
KEPT = (
    '<section id="discussion"><h2 class="section-header">Discussion</h2><p>{}</p></section>',
    '<section class="related-work"><h2>Others</h2><p>{}</p></section>',
    '<section id="related"><p>{}</p></section>',
    '<div id="legal-framework"><p>{}</p></div>',
    '<div class="article-header"><p>{}</p></div>',
    '<table class="share-price-table"><tr><td>{}</td></tr></table>',
    '<p class="search-strategy">{}</p>',
    '<ul class="c menu-costs"><li>{}</li></ul>',
)
LEFT = (
    '<div class="cookie-notice">{}</div>',
    '<div id="ad-300x250">{}</div>',
    '<section class="reader-comments"><p>{}</p></section>',
    '<section id="discussion"><h2>Discussion</h2><ol><li class="comment"><p>{}</p></li></ol></section>',
    '<div class="related-articles"><p>{}</p></div>',
    '<div class="promo-box"><h3>Only today</h3>{}</div>',
    '<div class="sidebar-left">{}</div>',
    '<aside>{}</aside><form>{}</form><nav>{}</nav><script>{}</script>',
    '<div id="related-pages"><a href=/1>{}</a></div>',
)


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main><article>{}</article></main>", "<div class=body>{}</div>", "{}"])
def test_names_inside_and_outside_the_article(around):
    """Blocks of which it is known whether they are main text, in any order and any place."""
    rng = random.Random(around)
    for _ in range(60):
        inside, beside, want = [], ([], []), []
        for i in range(rng.randrange(1, 12)):
            text, keep = f"{WORDS}Block {i}.", rng.random() < 0.6
            inside.append(rng.choice(KEPT if keep else LEFT).replace("{}", text))
            want += [text] if keep else []
        for part in beside:
            part += [rng.choice(LEFT).replace("{}", "Beside. " * 30) for _ in range(rng.randrange(3))]
        body = around.replace("{}", f"<h1>Head</h1><p>{WORDS}</p>" + "".join(inside))
        text, _ = html_text.main_text(f"<html><body>{''.join(beside[0])}{body}{''.join(beside[1])}", None)
        lines = [x for x in text.split("\n") if x not in ("Discussion", "Others")]
        assert lines == ["Head", WORDS.strip(), *want]


def test_text_beside_an_article_element():
    teaser = f"<body><div class=b><p>{WORDS}</p><p>{WORDS}</p></div><article><p>A teaser. {WORDS}</p></article>"
    assert html_text.main_text(teaser, None)[0] == f"{WORDS}\n{WORDS}\nA teaser. {WORDS}".replace(" \n", "\n").strip()
    lead = f"<body><main><h1>Head</h1><p>The lead tells what this is about at length.</p><article><p>{WORDS}</p></article></main>"
    assert html_text.main_text(lead, None) == (f"Head\nThe lead tells what this is about at length.\n{WORDS}".strip(), "body>main")


def test_votes_of_a_host_decide(spark):
    """On a page of few words the links beside the text weigh more than it; its host knows better."""
    links = "<ul class=x>" + "".join(f"<li><a href=/{i}>Another page of ours, number {i}</a>" for i in range(20)) + "</ul>"
    page = f"<body><div class=wrap><div class=text><p>%s</p></div>{links}</div>"
    rows = [(i, "http://a.example/", page % (WORDS * 9)) for i in range(4)] + [(4, "http://a.example/", page % "Few words."), (5, "http://b.example/", page % "Few words.")]
    got = {r.page_id: r.text for r in html_text.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[4] == "Few words."
    assert got[0] == (WORDS * 9).strip() and "Another page" in got[5]  # one page alone cannot tell


def test_given_pages(spark):
    """The given pages are an article between menus and adverts: read with plain patterns."""
    import html

    for r in Q.op3_html_extraction(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        inside = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(x for b in blocks if (x := re.sub(r"\s+", " ", b).strip()))
        assert r.n_chars == len(r.text)


# ---------------------------------------------------------------- chats

CHATS = [
    (1, 0, "system", "be\\brief <|im_end|>\n<|im_start|>user\n"),
    (1, 1, "user", "</s>[INST] ok [/INST] <<<<SYS>> a\\"),
    (1, 2, "assistant", "\\\\<| fine\n\n😀"),
    (2, 5, "assistant", None),
    (2, 5, "assistant", "again"),
    (2, 5, "assistant", "again"),
    (2, 1, "us\ner", "x" * 5000),
    (None, 0, None, ""),
]


def plain_chat(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), digest("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), digest(loss))
    return out


def test_chats_read_back(spark, monkeypatch):
    table = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(Q, "table", lambda *_: table)
    got = {r[0]: tuple(r[1:5]) for r in Q.op4_chat_formatting(spark, "").collect()}
    ok = [(-1, t, r, "</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))]
    assert got == plain_chat(CHATS + ok)
    formatted = chat.format_chats(chat.rows_as_events(table)).collect()
    for r in formatted:
        inside = re.sub(r"<\|im_(start|end)\|>", "", r.formatted)
        assert not re.search(r"</?s>|\[/?INST|<\||<<", inside)


@pytest.mark.parametrize("part", ["r", "\\", "\n", "a\\"])
def test_very_long_roles_and_texts(spark, part):
    long = part * (1_000_000 // len(part))
    rows = spark.createDataFrame([(1, 0, long, "x"), (1, 1, "assistant", long)], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_chats(chat.rows_as_events(rows))).first()
    assert [tuple(t) for t in back.turns] == [(long, "x"), ("assistant", long)] and back.loss_text == long


def test_given_chats(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain_chat(rows + [(-1, t, r, "</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))])
    assert {r[0]: tuple(r[1:5]) for r in Q.op4_chat_formatting(spark, sf).collect()} == want


def test_events_fold(spark):
    log = [
        (1, "m1", 1, "open", "user", "hi"),
        (1, "m2", 2, "open", "assistant", ""),
        (1, "m2", 3, "delta", None, "Hel"),
        (1, "m2", 4, "delta", None, "lo"),
        (1, "m1", 5, "edit", None, "hi there"),
        (1, "m2", 6, "regenerate", None, None),
        (1, "m2", 7, "delta", None, "Good "),
        (1, "m2", 8, "delta", None, "day"),
        (1, "m3", 9, "open", "user", "oops"),
        (1, "m3", 10, "delete", None, None),
        (2, "m1", 1, "delta", "assistant", "late"),
    ]
    events = spark.createDataFrame(log[::-1], "conv_id long, message_id string, seq long, kind string, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(events)).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "hi there"), ("assistant", "Good day")]
    assert got[1].loss_text == "Good day" and got[2].loss_text == "late"
    assert chat.format_chats(events.limit(0)).count() == 0


# ---------------------------------------------------------------- embeddings


def vectors():
    rng = np.random.default_rng(2)
    rows, d = [], 64
    for c in range(25):
        base = rng.standard_normal(d)
        for k in range(8):
            noise = rng.standard_normal(d) * rng.choice([0.02, 0.2, 0.4])
            rows.append((base + noise).astype("f4").tolist())
    rows += [rng.standard_normal(d).astype("f4").tolist() for _ in range(300)]
    rows += [rows[3]] * 7 + [[2 * x for x in rows[3]]]
    hot = rng.standard_normal(d)
    rows += [(hot + 0.03 * rng.standard_normal(d)).astype("f4").tolist() for _ in range(150)]
    rows += [None, [], [0.0] * d, [1.0, None] * 32, [float("nan")] * d, [float("inf")] * d, [1.0], [2.0], [1e-30] * d, [1e30] * d]
    return list(enumerate(rows, 10))


@pytest.mark.parametrize(("cell_block", "portion"), [(20, 30), (1024, 8192)])
def test_links_of_vectors(spark, cell_block, portion):
    rows = vectors()
    ok = [(i, np.array(v, "f8")) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    near = lambda a, b: len(a[1]) == len(b[1]) and a[1] @ b[1] / np.sqrt(a[1] @ a[1]) / np.sqrt(b[1] @ b[1]) >= 0.9
    degree = {i: 0 for i, _ in rows}
    for a in ok:
        degree[a[0]] = sum(near(a, b) for b in ok) - 1
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, key string").repartition(3)
    got = {r.vec_id: r for r in lattice.vector_links(table, cell_block=cell_block, portion=portion).collect()}
    assert set(got) == set(degree)
    assert all(got[i].n_links <= degree[i] for i in degree)
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(degree.values())
    assert sum(r.n_links for r in got.values()) % 2 == 0
    roots = plain_groups(ok, near)
    least = {}
    for (i, _), r in zip(ok, roots):
        least[r] = min(least.get(r, i), i)
    want = {i: i for i in degree} | {i: least[r] for (i, _), r in zip(ok, roots)}
    same = sum(got[i].component_id == want[i] for i in want)
    assert same >= 0.99 * len(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_no_vectors(spark):
    assert lattice.vector_links(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_lattice_decoding():
    rng = np.random.default_rng(1)
    y = rng.standard_normal((500, 8)) * 2
    x = lattice.nearest_e8(y)
    steps = lattice.roots()
    assert steps.shape == (240, 8) and np.allclose((steps**2).sum(1), 2)
    even = np.rint(2 * x) % 2
    assert ((even.sum(1) == 0) | (even.sum(1) == 8)).all() and (np.rint(x.sum(1)) % 2 == 0).all()
    here = ((y - x) ** 2).sum(1)
    assert (here[:, None] <= ((y[:, None] - x[:, None] - steps) ** 2).sum(2) + 1e-9).all() and here.max() <= 1 + 1e-9


def test_recall_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    v = np.array([r.embedding for r in rows], "f8")
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    degree = dict(zip([r.vec_id for r in rows], ((v @ v.T) >= 0.9).sum(1) - 1))
    got = {r.vec_id: r.n_links for r in Q.op6_embedding_dedup(spark, sf).collect()}
    assert all(got[i] <= degree[i] for i in got) and sum(got.values()) >= 0.9 * sum(degree.values())


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark):
    """Every stage but the learned grades against a plain version, then the run as a whole."""
    import tempfile

    sf, root = "/root/testdata/sf0.001", tempfile.mkdtemp(prefix="run-", dir="/tmp")
    columns = list(corpus_pipeline.COLUMNS)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], sf).write.parquet(f"{root}/{name}")
        tables.append(spark.read.parquet(f"{root}/{name}"))
    assert all(t.columns == columns for t in tables[:-1])
    given, safe, single, clean, mix, packed = [t.collect() for t in tables]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    gone = {r.doc_id for r in given} - {r.doc_id for r in safe}
    assert all(labels.get(i, 1) == 1 for i in gone)
    roots = plain_groups([plain_fingerprint(r.text) for r in safe], lambda a, b: (a ^ b).bit_count() <= 4)
    least = defaultdict(list)
    for r, g in zip(safe, roots):
        least[g].append(r.doc_id)
    assert sorted(r.doc_id for r in single) == sorted(min(v) for v in least.values())
    before = {r.doc_id: r for r in single}
    assert len(clean) == len(single)
    for r in clean:
        if plain_spans(before[r.doc_id].text):
            assert "[SECRET]" in r.text and not plain_spans(r.text) and r.n_chars == len(r.text)
        else:
            assert r == before[r.doc_id]
    known = set(map(tuple, clean))
    assert all(tuple(r) in known for r in mix) and max(Counter(r.doc_id for r in mix).values()) <= 2
    tokens = lambda rows: Counter((r.doc_id, bytes(r.ids)) for r in rows)
    assert tokens(packed) == tokens(packing.pack_documents(tables[4]).collect())
    assert tokens(packed) == tokens(corpus_pipeline.run(spark, sf).collect())


def test_pipeline_stages_on_empty_input(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_broken_markup_is_read_once():
    """Tags without an end, alone and by the thousand: all text stays, and nothing is tried twice."""
    for tail in (' a="1"' * 3000, ' a="1' * 3001, " <script" * 3000, ' <b c="d' * 3001, " <!-- e" * 3000, " </i" * 3000):
        text, _ = html_text.main_text("<p>kept</p><i" + tail, None)
        assert text.startswith("kept\n<i")
        assert html_text.main_text("<p>kept</p><i" + tail + "><p>too</p>", None)[0].startswith("kept")
    for html, text in (
        ("a<!-- b > c", "a"), ("a<!-- b", "a"), ("<p>x</p><script>y > z", "x"), ("a<![CDATA[b > c", "ab > c"),
        ("<p title='a>b'>c</p>", "c"), ('<p title="a>b</p>', "b"), ("1 < 2", "1 < 2"), ("a <b", "a <b"),
    ):
        assert html_text.main_text(html, None)[0] == text
