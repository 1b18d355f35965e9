"""Random bodies against a direct walk over the element tree."""

from __future__ import annotations

import random
import re
import xml.etree.ElementTree as ET

from scholion.operators import xml_articles as X
from scholion.operators.tokens import markup_tokens

WORDS = ["alpha", "beta", "end.Next", "gamma &amp; delta"]


def random_body(rng, depth=0):
    parts = []
    for _ in range(rng.randint(0 if depth else 1, 4)):
        kind = rng.choice(["p", "p", "sec", "title", "bold", "fig", "label", "list", "ref-list"])
        word = rng.choice(WORDS)
        if kind == "sec" and depth < 3:
            sec_type = rng.choice(["", "", " sec-type='abstract'", " sec-type='other'"])
            title = rng.choice(["", "<title>R</title>", "<title>S</title>", "<title> </title>"])
            parts.append(f"<sec{sec_type}>{title}{random_body(rng, depth + 1)}</sec>")
        elif kind == "p":
            inner = rng.choice(["", "<xref>1</xref>", "<sec><title>q</title></sec>", "<b>w</b>"])
            parts.append(f"<p>{word} {inner}</p>")
        elif kind == "list":
            parts.append(f"<list><li><p>{word}</p></li><li>x</li></list>")
        elif kind in ("title", "bold"):
            parts.append(f"<{kind}>{rng.choice(['R', 'S', word])}<xref>2</xref></{kind}>")
        elif kind != "sec":
            parts.append(f"<{kind}><p>{word}</p></{kind}>")
    return "".join(parts)


def squash(text):
    return re.sub(r"\s+", " ", text).strip()


def full(node):
    """All text below a node; blank text nodes do not count."""
    keep = lambda t: t if t and t.strip() else ""
    return keep(node.text) + "".join(full(c) + keep(c.tail) for c in node)


def prose(node):
    keep = lambda t: t if t and t.strip() else ""
    return keep(node.text) + "".join(
        ("" if c.tag in X.IGNORED else prose(c)) + keep(c.tail) for c in node
    )


def skipped(node):
    return (
        node.tag in X.IGNORED
        or node.tag == "ref-list"
        or (node.tag == "sec" and node.get("sec-type", "").lower() in X.SKIPPED_SEC_TYPES)
    )


def sec_lines(sec):
    title = sec.find("title")
    lines = [] if title is None else [squash(full(title))]
    for child in sec:
        if child.tag == "title" or skipped(child):
            continue
        if child.tag == "sec":
            lines += sec_lines(child)
        else:
            lines.append(squash(full(child) if child.tag in X.HEADINGS else prose(child)))
    return [x for x in lines if x]


def model(body):
    groups, heading, lines = [], "", []
    for node in body:
        if skipped(node):
            continue
        if node.tag in X.HEADINGS:
            groups.append((heading, lines))
            heading, lines = squash(full(node)), []
        elif node.tag == "sec":
            groups.append((heading, lines))
            title = node.find("title")
            groups.append(("" if title is None else squash(full(title)), sec_lines(node)))
            heading, lines = "", []
        else:
            lines.append(squash(prose(node)))
    groups.append((heading, lines))
    keys, found, n = set(), [], 1
    for title, lines in groups:
        text = "\n".join(x for x in lines if x)
        if not text:
            continue
        if not title:
            title, n = f"section_{n}", n + 1
        key = title
        while key in keys:
            key, n = f"{title}_{n}", n + 1
        keys.add(key)
        found.append((key, re.sub(r"\.([A-Z])", r". \1", text)))
    return found


def test_random_bodies(spark):
    rng = random.Random(7)
    bodies = {i: f"<body>{random_body(rng)}</body>" for i in range(400)}
    payloads = spark.createDataFrame(
        [(i, f"<article>{b}</article>") for i, b in bodies.items()], "doc_id int, payload string"
    )
    tokens = markup_tokens(payloads)
    rows = X.xml_section_keys(X.xml_sections(tokens)).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["ord"])):
        got.setdefault(r["doc_id"], []).append((r["key"], r["text"]))
    want = {i: model(ET.fromstring(b)) for i, b in bodies.items() if len(ET.fromstring(b))}
    assert got == {i: v for i, v in want.items() if v}
