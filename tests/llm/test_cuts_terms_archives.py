"""Fill-in-the-middle, source divergence and web archives against plain versions."""

import gzip
import hashlib
import io
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from scholion.llm import divergence, fill_in_middle, warc
from scholion.llm import queries as Q
from scholion.llm.common import shared_folder

SCHEMA = "doc_id long, text string, lang string, source string, n long, form string, term string, url string"
TOKENS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")

# ---------------------------------------------------------------- fill-in-the-middle

rng = random.Random(7)
LONG = "".join(rng.choice(["a", " ", "bc", "\n", "日本", "😀", " ", "\t \r"]) for _ in range(150_000))
TEXTS = [None, "", " ", "a", " a", "a ", "a  b\n", "x <P> y z", "<M", "<S<P", "P> <S", "é  \x0b\x1c z", "one two three four " * 50, LONG, "z" * 200_000, " " * 140_000]
SHORT = [t for t in TEXTS if len(t or "") < 1000]
ROWS = [(i, t) for i in [*range(20), -3, 10**15, None] for t in SHORT] * 2 + [(i, t) for i in (1, 4) for t in TEXTS]


def plain_cut(doc_id, text):
    text = text or ""
    tokens = TOKENS.findall(text)
    assert "".join(tokens) == text
    n = len(tokens)
    digest = hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    cut = sorted(x % (n + 1) for x in h[:2])
    pre, mid, suf = ("".join(tokens[a:b]) for a, b in ((0, cut[0]), (cut[0], cut[1]), (cut[1], n)))
    spm = h[3] % 100 < 80
    out = f"<S>{suf}<P>{pre}<M>{mid}" if spm else f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, n, "spm" if spm else "psm", len(pre), len(mid), out


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", "y", "z") for i, t in rows], SCHEMA)


def test_cuts(spark):
    want = Counter(plain_cut(*r) for r in ROWS)
    made = fill_in_middle.fill_in_middle(documents(spark, ROWS).repartition(3))
    back = made.withColumn("back", fill_in_middle.restored(made.output, made.form)).collect()
    assert Counter(tuple(r[:6]) for r in back) == want
    assert Counter((r.doc_id, r.back) for r in back) == Counter((i, t or "") for i, t in ROWS)
    assert {r.form for r in back} == {"plain", "spm", "psm"}
    assert fill_in_middle.fill_in_middle(documents(spark, [])).count() == 0


def test_containers():
    kinds = set()
    for size, of in ((1, 70), (300, 65_536), (5000, 65_536), (40_000, 65_536)):
        values = np.array(sorted(random.Random(size).sample(range(of), size)))
        box = fill_in_middle.container(values)
        kinds.add(type(box).__name__)
        assert [box.select(k) for k in range(size)] == values.tolist()
    runs = np.array([*range(10, 3000), *range(4000, 65_536)])
    box = fill_in_middle.container(runs)
    kinds.add(type(box).__name__)
    assert [box.select(k) for k in range(0, len(runs), 7)] == runs[::7].tolist()
    assert kinds == {"ArrayContainer", "BitmapContainer", "RunContainer"}


@pytest.mark.parametrize("text", [LONG, "ab " * 60_000, "a" * 65_535 + " ", "a" * 65_536 + " ", " " * 65_537 + "b"])
def test_positions_of_long_texts(text):
    ends, at = fill_in_middle.token_ends(text), -1
    sizes = [len(t) for t in TOKENS.findall(text)]
    assert len(ends) == len(sizes)
    step = max(1, len(sizes) // 500)
    for k, size in enumerate(sizes):
        at += size
        if k % step == 0 or k == len(sizes) - 1:
            assert ends.select(k) == at


def test_cuts_at_characters(spark):
    rows = [(i, "abc défg" * 30) for i in range(40)]
    made = fill_in_middle.fill_in_middle(documents(spark, rows), unit="character", transformed_percent=100)
    back = made.withColumn("back", fill_in_middle.restored(made.output, made.form)).collect()
    assert all(r.back == rows[0][1] and r.n == len(r.back) and r.form != "plain" for r in back)
    with pytest.raises(ValueError):
        fill_in_middle.fill_in_middle(documents(spark, rows), unit="word")


# ---------------------------------------------------------------- divergence


def plain_divergence(rows, top=200):
    groups, within, held = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        held.add((lang, source))
        groups[lang, source].update(words)
        within[lang].update(set(words))
    out = []
    for lang, source in held:
        kept = sorted((t for t, d in within[lang].items() if d >= 3), key=lambda t: t.encode())
        v = len(kept)
        count = {s: [groups[lang, s][t] for t in kept] for (k, s) in held if k == lang}
        whole = [sum(c) for c in zip(*count.values())]
        share = lambda cs: [1 + 10**9 * (c + 1) // (sum(cs) + v) for c in cs]
        p = share(count[source])
        score = lambda q: [(x - y) ** 2 // y for x, y in zip(p, q)]
        pairs = [(s, sum(score(share(c)))) for s, c in count.items() if s != source]
        q = share(whole)
        terms = [(t, f) for t, f, c, x, y in zip(kept, score(q), count[source], p, q) if c and x > y]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda r: (-r[1], r[0].encode()))
            out += [(lang, source, part, item, f, i) for i, (item, f) in enumerate(found[:most], 1)]
    return Counter(out)


def random_documents(seed, n=400):
    r = random.Random(seed)
    letters = ["a", "B", "é", "ß", "日", "😀", "\U00010000", "￮", "z"]
    vocabulary = ["".join(r.choices(letters, k=r.randint(1, 3))) for _ in range(150)]
    weights = [1 / (i + 1) for i in range(150)]
    rows = []
    for _ in range(n):
        lang, source = r.choice(["en", "fr", None, ""]), r.choice(["s1", "s1", "s1", "s2", "é", None])
        words = r.choices(vocabulary if source != "s2" else vocabulary[::-1], weights, k=r.randint(0, 30))
        rows.append((r.choice([" ", "_1 ", "\n"]).join(words), lang, source))
    rows += [(None, "xx", "s1"), ("only once", "xx", "s3"), ("", "yy", None), ("Rare RARE rare", "zz", "q")]
    return rows + rows[:60]


def divergence_table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 1, "f", "t", "u") for i, (t, lang, s) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("top", [3, 200])
def test_divergence(spark, top):
    rows = random_documents(top)
    got = divergence.source_divergence(divergence_table(spark, rows).repartition(5), top=top).collect()
    assert Counter(tuple(r) for r in got) == plain_divergence(rows, top)


def test_divergence_in_small_portions(spark, monkeypatch):
    """Tables, matrices and sums at their bounds give the same rows."""
    for name, value in (("TALLY_ENTRIES", 5), ("MATRIX_CELLS", 7), ("SUM_CELLS", 4), ("CHUNK", 3)):
        monkeypatch.setattr(divergence, name, value)
    rows = random_documents(11, 150)
    got = divergence.source_divergence(divergence_table(spark, rows).repartition(3)).collect()
    assert Counter(tuple(r) for r in got) == plain_divergence(rows)


def test_tallies_in_small_portions(monkeypatch):
    import pyarrow as pa

    rows = [("l", "s", b"A b a"), ("l", "s", b"a c"), ("l", "t", b"B"), ("l", "s", None or b""), ("l", "s", b"b d e f")]
    batch = pa.RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), r)) for r in rows])
    ids = {("l", "s"): 0, ("l", "t"): 1}
    for entries in (0, 300_000):
        monkeypatch.setattr(divergence, "TALLY_ENTRIES", entries)
        n, docs = Counter(), Counter()
        for out in divergence.tally_terms(iter([batch] * 2), ids):
            for r in out.to_pylist():
                n["st"[r["id"]], r["term"]] += r["n"]
                docs["st"[r["id"]], r["term"]] += r["docs"]
        assert n == {("s", "a"): 6, ("s", "b"): 4, ("s", "c"): 2, ("s", "d"): 2, ("s", "e"): 2, ("s", "f"): 2, ("t", "b"): 2}
        assert docs["s", "a"] == 4 and docs["s", "b"] == 4


def test_no_documents(spark):
    assert divergence.source_divergence(divergence_table(spark, [])).count() == 0


def test_skyband_keeps_what_few_dominate(spark):
    r = random.Random(3)
    rows = [("l", f"g{i % 2}", f"t{i:04d}", r.randint(1, 9), r.randint(9, 30)) for i in range(900)]
    table = spark.createDataFrame(rows, "lang string, source string, term string, n long, total long")
    got = {x.term for x in divergence.skyband(table.repartition(1), 5).collect()}
    for _, g, t, n, total in rows:
        over = sum(h == g and u < t and m >= n and s <= total for _, h, u, m, s in rows)
        assert (t in got) == (over < 5)


def test_shares_are_exact():
    r = random.Random(5)
    wholes = [1, 2, 7, 10**9 + 7, 10**12 + 39, 9 * 10**15]
    counts = np.array([[r.randint(0, w - 1) for w in wholes] for _ in range(300)], "int64")
    got = divergence.shares(counts, np.array(wholes, "int64"))
    assert got.tolist() == [[1 + 10**9 * (c + 1) // w for c, w in zip(line, wholes)] for line in counts.tolist()]


# ---------------------------------------------------------------- archives

COPY = "<p>" + "copy " * 40
PAGES = [
    (5, "http://a.example/x", COPY),
    (3, "http://b.example/ü ?q=a b", COPY),
    (3, "http://b.example/", COPY),
    (None, None, COPY),
    (9, "", None),
    (10, "http://c.example", ""),
    (11, "http://c.example", "short"),
    (12, "http://c.example", "short"),
    (-4, "http://d.example", "WARC/1.1\r\nContent-Length: 3\r\n\r\n" * 9 + "\r\n\r\n"),
    (2**62, "http://d.example", "filedesc://x 0 0 text/plain 9\nhttp://x 0.0.0.0 2 text/html 4\n" * 4),
    (-(2**63), "http://d.example", "HTTP/1.1 200 OK\r\nX-Page-Id: 77\r\n\r\n" + "y" * 100),
    (20, "http://e.example", "é" * 50),
    (21, "http://e.example", "é" * 50),
    (22, "http://e.example", "x" * 99),
    (23, "http://e.example", "x" * 99),
    (30, "http://f.example", "Lang " * 400_000),
]


def plain_pages(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    least = {}
    for i, b in payloads:
        if i is not None:
            least[b] = min(least.get(b, i), i)
    out, taken = [], set()
    for i, b in sorted(payloads, key=lambda r: (r[0] is None, r[0] or 0)):
        again = len(b) >= 100 and b in taken
        taken.add(b)
        digest = hashlib.sha256(b).hexdigest()
        out.append((i, len(b), digest, "revisit" if again else "response", least.get(b) if again else None))
    return Counter(out)


def pages_table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, offset long")


@pytest.mark.parametrize("versions, limit, parts", [((1,), 1000, 1), ((2,), 1 << 20, 3), ((1, 2), 300, 2)])
def test_pages_through_archives(spark, monkeypatch, versions, limit, parts):
    table = pages_table(spark, PAGES).repartition(parts)
    monkeypatch.setattr(Q, "table", lambda *_: table)
    read = warc.pages_through_archives(table, versions, limit).collect()
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to_page) for r in read)
    assert got == plain_pages(PAGES)
    assert len({r.record_id for r in read}) == len(read)
    assert Counter(tuple(r) for r in Q.op13_warc(spark, "").collect()) == got
    by_id = {r.record_id: r for r in read}
    for r in read:
        if r.record_type == "revisit":
            assert by_id[r.refers_to].payload_digest == r.payload_digest and by_id[r.refers_to].record_type == "response"


def test_payloads_and_headers_come_back(spark):
    root = shared_folder(spark)
    warc.write_archives(warc.arc_archives(pages_table(spark, PAGES), limit=2000), f"{root}/arc", "\n")
    found = warc.read_arc(spark, f"{root}/arc").collect()
    assert {r.version for r in found} == {1, 2} and all(r.whole and r.date == warc.FETCHED for r in found)
    assert "http://b.example/%C3%BC%20?q=a%20b" in {r.url for r in found}
    warc.convert_archives(spark, f"{root}/arc", f"{root}/warc", 2000)
    back = warc.read_warc(spark, f"{root}/warc").collect()
    sent = {i: (h or "").encode() for i, _, h in PAGES}
    assert all(bytes(r.payload) == sent[r.page_id] for r in back if r.record_type == "response")
    assert {r.date for r in back} == {"2024-01-01T00:00:00Z"}
    assert {r.target_uri for r in back if r.page_id is None or r.page_id == 9} == {None}


def test_no_pages(spark):
    assert warc.pages_through_archives(pages_table(spark, [])).count() == 0


def test_archives_from_elsewhere(spark):
    """Version-specific headers, URLs with spaces, bytes that are no text, no HTTP, a cut-off end."""
    body = b"1 0 x\n" + warc.ARC_FIELDS[1].encode() + b"\n"
    one = b"filedesc://old.arc 0.0.0.0 19961010 text/plain %d\n" % len(body) + body
    one += b"\nhttp://a/b c 10.0.0.1 19961010101010 image/gif 4\n\xff\x00\n\n\n"
    one += b"dns:a 10.0.0.1 1996 text/dns 5\nabcde\n\nhttp://cut/ 1.1.1.1 19970101 text/html 90\nleft"
    records = list(warc.arc_records(warc.opened(gzip.compress(one[:200]) + gzip.compress(one[200:]))))
    assert [(r.url, r.block, r.whole) for r in records] == [
        (b"http://a/b c", b"\xff\x00\n\n", True), (b"dns:a", b"abcde", True), (b"http://cut/", b"left", False)
    ]
    assert [one[r.offset :].startswith(r.url) for r in records] == [True] * 3
    rows = [{**r._asdict(), "file": "f", "page_id": None, "first": None, "digest": hashlib.sha256(r.block).hexdigest()} for r in records]
    texts = [{k: v.decode() if k in ("url", "address", "date", "kind") else v for k, v in r.items()} for r in rows]
    written = b"\r\n\r\n".join([warc.warc_info("n"), *map(warc.converted, texts), b""])
    back = list(warc.warc_records(io.BytesIO(written)))
    assert [f["warc-type"] for _, f, _ in back] == ["warcinfo", "resource", "resource", "resource"]
    assert [b for _, _, b in back[1:]] == [r.block for r in records]
    assert [f["warc-date"] for _, f, _ in back[1:]] == ["1996-10-10T10:10:10Z", "1996-01-01T00:00:00Z", "1997-01-01T00:00:00Z"]
    assert back[3][1]["warc-truncated"] == "unspecified"
    for bad in (b"no header\n", b"http://a 1 2 text/html x\n", one.replace(b"\n1 0 x", b"\n7 0 x")):
        with pytest.raises(ValueError):
            list(warc.arc_records(io.BytesIO(bad)))
    with pytest.raises(ValueError):
        list(warc.warc_records(io.BytesIO(written[:-12])))
    tampered = dict(back[1][1])
    with pytest.raises(ValueError):
        warc.warc_row("f", 0, tampered, back[1][2] + b"!", True)


def test_ids_hold_pages():
    for page in (0, 1, -1, 2**63 - 1, -(2**63), 123456789):
        assert warc.page_of(f"<urn:uuid:{warc.record_id(page, 'a/b', 17)}>") == page
    assert warc.page_of(warc.record_id(None, "b", 3)) is None and warc.page_of(None) is None
    assert len({warc.record_id(None, "x", i) for i in range(1000)}) == 1000
