from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import html_extraction
from tidemark.llm.html_extraction import ARTICLE, LONG, REGION, blocks_of, extract_text, host_of, stream_of, suffix_order

KINDS = "page_id long, url string, html string"


def text_of(page):
    return "\n\n".join(t for kind, t in blocks_of(page) if kind in (ARTICLE, REGION))


def plain(rows):
    """Text and repeated tokens by dictionaries of all runs."""
    pages = [(i, url, host_of(url), blocks_of(page)) for i, url, page in rows]
    seen = defaultdict(set)
    for _, _, host, blocks in pages:
        tokens, _ = stream_of(blocks)
        for i in range(len(tokens) - LONG + 1):
            seen[host, tuple(tokens[i : i + LONG])].add(tuple(t for _, t in blocks))
    out = []
    for number, url, host, blocks in pages:
        tokens, _ = stream_of(blocks)
        gone = set()
        for i in range(len(tokens) - LONG + 1):
            if len(seen[host, tuple(tokens[i : i + LONG])]) > 1:
                gone |= set(range(i, i + LONG))
        at, kept = 0, []
        for kind, text in blocks:
            words = text.split(" ")
            if kind == ARTICLE:
                kept.append(text)
                continue
            left = [w for k, w in enumerate(words) if at + 1 + k not in gone]
            at += 1 + len(words)
            if kind == REGION and left:
                kept.append(" ".join(left))
        text = "\n\n".join(kept)
        out.append((number, url, text, len(text), len(gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("just text &amp; more", "just text & more"),
        ("<article><h1>T</h1><p>a  b\n c<br>d<p>e &lt;i&gt; <b>f</b>g</article><p>no</p>", "T\n\na b c d\n\ne <i> fg"),
        ("<nav>no</nav><header>no</header><article>x<footer>no</footer><aside>no</aside></article>", "x"),
        ("<article><header><h1>Title</h1></header><p>x</article>", "Title\n\nx"),
        ("<article><p>x</p><div class='post-comments'><p>no</div><form>no<input></form><p>y</article>", "x\n\ny"),
        ("<article>x<section id=comments><article>no</article></section></article>", "x"),
        ("<body><div class='cookie notice'>no</div><main><p>x</main><p>no</body>", "x"),
        ("<div id=content><p>x</div><div>no</div>", "x"),
        ("<article><script>var t='</p><p>no';</script><style>p{}</style><!-- no --><p>x</article>", "x"),
        ("<article><p><b>x<p>y</b> z</p></article>", "x\n\ny z"),
        ("<article><p title='a>b'>x</p><p title=\"open>y</p></article>", "x\n\ny"),
        ("<article><ul><li>a<li><a href=/>b</a> c</ul><table><tr><td>d<td>e</table></article>", "a\n\nb c\n\nd\n\ne"),
        ("<article>1 < 2 &am &amp &copy; &#233;&#x41; &nosuch;</article>", "1 < 2 &am & © éA &nosuch;"),
        ("<article><p>cut <b>of", "cut of"),
        ("<article></article><p>no</p>", ""),
        ("<article><div hidden>no</div><p aria-hidden=true>no</p><p style='display: none'>no</p>x</article>", "x"),
        ("<article><p>a</p>" + "<div>" * 30_000 + "b</article>", "a\n\nb"),
    ],
)
def test_blocks(page, text):
    assert text_of(page) == text


def test_suffix_order():
    draw = random.Random(1)
    for n in (0, 1, 5, 300):
        codes = np.array([draw.randrange(3) for _ in range(n)], dtype=np.uint64)
        order, rank = suffix_order(codes, 8)
        starts = [tuple(codes[i : i + 8].tolist()) for i in range(n)]
        assert [starts[i] for i in order] == sorted(starts)
        assert all((rank[i] == rank[j]) == (starts[i] == starts[j]) for i in range(n) for j in range(0, n, 7))


def site(n):
    """Pages without an article element, which share menus, a notice, a long passage, and some whole pages."""
    draw, rows = random.Random(2), []
    word = [f"w{i}" for i in range(300)]
    menu = " ".join(f"<li>{draw.choice(word)} {draw.choice(word)}</li>" for _ in range(8))
    for i in range(n):
        own = " ".join(draw.choices(word, k=draw.randint(0, 40)))
        notice = f"<p>{' '.join(word[5 : draw.choice([9, 12, 25])])} {draw.choice(word)}</p>" if i % 3 else ""
        page = f"<body><ul>{menu if i % 4 else ''}</ul>{notice}<p>{own}</p><footer>{own} end</footer></body>"
        if i % 5 == 4:
            page = rows[-1][2]
        rows.append((draw.choice([None, i, i]), f"http://h{draw.choice([1, 1, 2])}.example.com/{i}", page))
    return rows


@pytest.mark.parametrize("size", [4 << 20, 1500, 1])
def test_repeated_runs_against_all_runs(spark, monkeypatch, size):
    monkeypatch.setattr(html_extraction, "SHARD_BYTES", size)
    rows = site(90)
    want = plain(rows)
    found = extract_text(spark.createDataFrame(rows, KINDS).repartition(3)).collect()
    assert sorted((tuple(r) for r in found), key=str) == want
    assert any(r[4] for r in want) and any(r[3] for r in want)


def test_copies_of_a_page_keep_their_text(spark):
    page = "<body><p>" + " ".join(f"w{i}" for i in range(30)) + "</p></body>"
    rows = [(i, "http://a.example.com/", page) for i in range(3)]
    rows.append((3, "http://a.example.com/", page.replace("</p>", " and more</p>")))
    found = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows[:3], KINDS)).collect()}
    assert set(found.values()) == {text_of(page)}
    found = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows, KINDS)).collect()}
    assert found == {0: "", 1: "", 2: "", 3: "and more"}  # now several pages share it


def test_odd_rows(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 40_000 + "</article>"
    rows = [(None, None, None), (1, "not an address", ""), (1, None, "<p>a"), (1, None, "<p>a"), (2, "http://x/", long)]
    names = KINDS + ", host string, text string, shard long, `a.b` int, run long, blocks string"
    docs = spark.createDataFrame([(*r, "h", "t", 1, 2, 3, "b") for r in rows], names)
    found = sorted((tuple(r) for r in extract_text(docs).collect()), key=str)
    assert found == plain(rows) and max(r[3] for r in found) > 400_000
    assert extract_text(spark.createDataFrame([], KINDS)).count() == 0
