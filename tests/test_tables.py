"""Tables of fragments and of nested wraps, against a walk over the tree."""

from __future__ import annotations

import json
import random
import re
import xml.etree.ElementTree as ET

from scholion.operators import xml_articles as X
from scholion.operators.tokens import markup_tokens

IGNORED = X.IGNORED


def whole_text(node):
    return re.sub(r"\s+", " ", "".join(node.itertext())).strip()


def cell_text(node):
    def parts(n):
        yield n.text or ""
        for child in n:
            if child.tag not in IGNORED:
                yield from parts(child)
            yield child.tail or ""

    return re.sub(r"\s+", " ", "".join(parts(node))).strip()


def plain_tables(root):
    for node in root.iter():  # text of white space only does not exist
        node.text, node.tail = (x if (x or "").strip() else None for x in (node.text, node.tail))
    out = []
    for wrap in root.iter("table-wrap"):
        table = next((t for t in wrap.iter("table")), None)
        if table is None:
            continue
        first = lambda path: next((t for n in wrap.findall(path) if (t := whole_text(n))), None)
        label, title = wrap.find("label"), wrap.find("caption/title")
        name = next((t for n in (label, title) if n is not None and (t := whole_text(n))), None)
        name = name or (wrap.get("id").strip() if wrap.get("id") is not None else "Table")
        notes = [t for p in wrap.findall("caption//p") if (t := whole_text(p))]
        notes = notes or [t for t in [first("caption")] if t]
        notes += [t for p in wrap.findall("table-wrap-foot//p") if (t := whole_text(p))]
        heads = table.findall(".//thead//th")
        columns = [t for th in heads or [h for r in table.findall("tbody/tr[1]") for h in r.iter("th")] if (t := cell_text(th))]
        data = [
            [cell_text(td) for td in tr.findall("td")]
            for part in ("tbody", "tfoot") for p in table.findall(part) for tr in p.findall("tr") if tr.find("td") is not None
        ]
        out.append((name, json.dumps({"TableName": name, "Description": " ".join(notes) or None, "Colmuns": columns, "Data": data}, ensure_ascii=False, separators=(",", ":"))))
    return out


def found_tables(spark, payloads, scoped):
    df = spark.createDataFrame(list(enumerate(payloads)), "doc_id long, payload string")
    rows = {}
    for r in X.xml_table_json(scoped(markup_tokens(df))).orderBy("doc_id", "table_no").collect():
        rows.setdefault(r.doc_id, []).append((r["name"], r.json))
    return rows


def table(rows, head=""):
    return f"<table>{head}<tbody>{rows}</tbody></table>"


LEAF = "<table-wrap><label>In</label>" + table("<tr><td>i</td></tr>") + "</table-wrap>"
FRAGMENTS = [
    LEAF,
    "<x>" + LEAF + LEAF + "</x>",
    "<table-wrap id='o'>" + table("<tr><td>a</td><td>b " + LEAF + " c</td></tr><tr><td>d</td></tr>") + "<table-wrap-foot><p>n</p></table-wrap-foot></table-wrap>",
    "<table-wrap id='o'><caption><p>cap " + LEAF + "</p></caption>" + table("<tr><td>own</td></tr>") + "</table-wrap>",
    "<table-wrap id='a'>" + table("<tr><td><table-wrap id='b'>" + table("<tr><td>" + LEAF + "</td><td>2</td></tr>") + "</table-wrap></td><td>1</td></tr>") + "</table-wrap>",
    "<table-wrap id='o'>" + LEAF + LEAF + "</table-wrap>",
    "<table-wrap id='o'><graphic/><table-wrap/></table-wrap>",
    "<fragment>text only</fragment>",
    "<article><front/><body>" + LEAF + "</body></article>",
    "<set><article><body>" + LEAF + "</body></article><article>" + LEAF + "</article></set>",
]


def test_fragments(spark):
    found = found_tables(spark, FRAGMENTS + ["<broken><table-wrap>", "", "plain"], X.xml_fragment)
    for i, payload in enumerate(FRAGMENTS):
        assert found.get(i, []) == plain_tables(ET.fromstring(payload)), payload
    assert set(found) <= set(range(len(FRAGMENTS)))


def random_wrap(r, depth):
    inner = lambda: random_wrap(r, depth - 1) if depth and r.random() < 0.3 else ""
    cells = lambda: "".join(f"<td>{r.randint(0, 99)} <b>x</b>{inner()}<xref>9</xref></td>" for _ in range(r.randint(0, 3)))
    rows = lambda tag: f"<{tag}>" + "".join(f"<tr>{cells()}</tr>" for _ in range(r.randint(0, 3))) + f"</{tag}>"
    own = f"<table>{rows('tbody')}{rows('tfoot') if r.random() < 0.5 else ''}{rows('tbody')}</table>" if r.random() < 0.8 else ""
    parts = [
        r.choice(["", "<label>L</label>", "<label> </label>"]),
        r.choice(["", f"<caption><title>T{inner()}</title><p>c {r.randint(0, 9)}{inner()}</p></caption>", f"<caption>bare{inner()}</caption>"]),
        inner(), own, r.choice(["", "<table-wrap-foot><fn><p>f</p></fn><p> </p></table-wrap-foot>"]), inner(),
    ]
    return f"<table-wrap{r.choice(['', ' id=' + chr(34) + ' k ' + chr(34)])}>{''.join(parts)}</table-wrap>"


def test_random_nested_wraps(spark):
    r = random.Random(8)
    payloads = ["<body>" + "".join(random_wrap(r, 3) for _ in range(r.randint(1, 3))) + "</body>" for _ in range(120)]
    found = found_tables(spark, payloads, X.xml_fragment)
    for i, payload in enumerate(payloads):
        assert found.get(i, []) == plain_tables(ET.fromstring(payload)), payload
    articles = [f"<article>{p}</article>" for p in payloads]
    assert found_tables(spark, articles, X.xml_first_article) == found
    df = spark.createDataFrame(list(enumerate(articles)), "doc_id long, payload string")
    for row in X.xml_articles(df).collect():
        texts = [v for k, v in (row.sections or {}).items() if v.startswith('{"TableName"')]
        assert sorted(texts) == sorted(j for _, j in found.get(row.doc_id, []))
