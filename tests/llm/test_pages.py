"""Archives, page text and chat."""

import hashlib
import io
import re
from html import unescape

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, html, queries, warc


class Opened(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def records(data):
    return [(kind, what if kind == "gap" else what[1]) for kind, _, _, what in warc.salvage(Opened(data))]


@pytest.fixture
def archive():
    parts = [warc.record(i, f"http://a/{i}", b"page %d " % i * 50, "0" * 64, None) for i in range(4)]
    return parts, [warc.member(part) for part in parts]


def test_salvage_reads_sound_archives(archive):
    plain, members = archive
    assert [kind for kind, _ in records(b"".join(members))] == ["record"] * 4
    assert [kind for kind, _ in records(b"".join(plain))] == ["record"] * 4
    assert records(b"") == []


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_goes_on_after_damage(archive, packed):
    parts = archive[1] if packed else archive[0]
    middle = bytearray(parts[1])
    middle[len(middle) // 2] ^= 0xFF
    got = records(parts[0] + bytes(middle) + b"junk" + parts[2] + parts[3][:-9])
    assert [kind for kind, _ in got] == ["record", "gap", "record", "gap"]
    sized = list(warc.salvage(Opened(parts[0] + bytes(middle) + b"junk" + parts[2])))
    gap = next((begin, end) for kind, begin, end, _ in sized if kind == "gap")
    assert gap == (len(parts[0]), len(parts[0]) + len(middle) + 4)


def test_archives_of_odd_pages(spark, tmp_path):
    same = "<p>" + "y" * 200
    rows = [
        (3, "http://a/3", same, 0), (1, "http://a/1\r\nX: y%0A", same, 0), (2, None, same, 0), (2, None, same, 0),
        (4, "u", None, 0), (5, "u", "", 0), (6, "u", "short", 0), (7, "u", "short", 0), (None, "u", same, 0),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    read = warc.read_archives(warc.write_archives(pages, f"file://{tmp_path}")).collect()
    got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in read)
    assert got == [
        (0, "revisit", 1, 203), (1, "response", None, 203), (2, "revisit", 1, 203), (2, "revisit", 1, 203),
        (3, "revisit", 1, 203), (4, "response", None, 0), (5, "response", None, 0), (6, "response", None, 5),
        (7, "response", None, 5),
    ]
    assert {r.payload_digest for r in read if r.payload_bytes == 203} == {hashlib.sha256(same.encode()).hexdigest()}
    assert next(r.url for r in read if r.page_id == 1) == "http://a/1\r\nX: y%0A"
    assert queries.warc.archive_pages(spark, pages.limit(0)).isEmpty()


def test_headers_of_any_length(spark, tmp_path):
    url = "data:text/html," + "x" * (2 << 20)
    plain = [warc.record(i, url, b"<p>page", "0" * 64, None) for i in range(2)]
    for parts in (plain, list(map(warc.member, plain))):
        assert [kind for kind, _ in records(b"".join(parts))] == ["record"] * 2
    pages = spark.createDataFrame([(1, url, "<p>page"), (2, "u", "x")], "page_id long, url string, html string")
    read = warc.read_archives(warc.write_archives(pages, f"file://{tmp_path}")).collect()
    assert {r.page_id: r.url for r in read} == {1: url, 2: "u"} and not any(r.problem for r in read)


def test_a_lost_record_fails_the_query(spark, tables, monkeypatch):
    whole = warc.archive_pages

    def damaged(*given):
        return whole(*given).withColumn("problem", F.when(F.col("page_id") % 5 == 0, "no header"))

    monkeypatch.setattr(warc, "archive_pages", damaged)
    with pytest.raises(Exception, match="cannot be read back: no header"):
        queries.op9_warc(spark, tables).count()


def test_main_text():
    page = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
      <header><a>Site</a></header><nav><ul><li>Menu<li>More</ul></nav><div class="cookie-notice">We use</div>
      <article><header><h1>A &amp; B</h1></header><p>One <b>two</b>&nbsp;\n three.<p>Four<br>five
      <form><p>ask</form><div class="ad-slot">buy</div><script>var t="</p>";</script>
      <ul><li>x<li>y</ul><section id="comments"><p>me too</section></article>
      <aside>side</aside><div id="footer">foot</div></body>"""
    assert html.main_text(page) == "A & B\nOne two three.\nFour five\nx\ny"
    assert html.main_text("") == "" and html.main_text("plain  text") == "plain text"
    assert html.main_text("<![weird[ <p>a<p>b") == "a\nb"
    assert html.main_text("<div>" * 5000 + "deep") == "deep"


def test_names_and_kinds_keep_the_articles_own_text():
    page = """<article><h1>T</h1><h2 id="search">How search works</h2><p>A.</p><section id="related-work"><p>Prior work
      by others.</p></section><p>Then <math><mi>x</mi></math> holds.</p><p id="notice-period">One month.</p><p>Say
      <label>this</label> and <button>press<div>here</div></button> that.</p><div class="social-history">H</div>
      <section id="search"><p>Again</p></section><div class="comment-list">bad</div><div class="ad-banner">bad</div>
      <p>end <object>alt</object> of <span hidden>nothing</span> it</p></article><div id="search">no</div>"""
    assert html.main_text(page).split("\n") == [
        "T", "How search works", "A.", "Prior work by others.", "Then x holds.", "One month.", "Say this and that.", "H",
        "Again", "end alt of it",
    ]


def test_names_vote_with_the_tree(spark):
    """Of two blocks of equal importance only the one goes whose name speaks against it."""
    rows = []
    for i in range(60):
        line = f"Line {i % 6} of some"
        rows.append((i, "http://site/", f"<article><p>own {i}</p><div class='related-x'>{line}</div><div class='k'>{line}</div></article>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    tree = {round(r.importance, 2) for r in html.style_tree(pages).collect()}
    assert any(html.LEAST_IMPORTANCE < x < html.VOTED_IMPORTANCE for x in tree), tree
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert got[7] == "own 7\nLine 1 of some" and got[9] == "own 9\nLine 3 of some"


def test_parts_of_hosts_change_nothing(spark, tables, monkeypatch):
    pages = spark.read.parquet(f"{tables}/pages.parquet")
    whole = {tuple(r) for r in html.extract(pages).collect()}
    monkeypatch.setattr(html, "PAGES", 3)
    monkeypatch.setattr(html, "CELLS", 4)
    assert {tuple(r) for r in html.extract(pages).collect()} == whole and len(whole) == pages.count()


def test_elements_beside_the_article_are_in_the_tree(spark):
    rows = [(i, "http://site/", f"<nav>All the site</nav><footer>own {i}</footer><article>text {i}</article>") for i in range(20)]
    tree = html.style_tree(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(round(r.importance, 2) for r in tree) == [0.0, 1.0, 1.0]


def test_site_tree_finds_what_all_pages_show(spark):
    rows = [
        (i, "https://U:p@Site.example:80/x", f"<body><div class=box{i}><p>Welcome to the site<p>All rights</div>"
         f"<div id=main-{i}><p>Text {i} of its own {i * i}<p>and more {i * 7}</div>")
        for i in range(12)
    ]
    rows += [(100 + i, "http://other/", "<body><div><p>equal</div>") for i in range(2)] + [(200, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("low", F.lit(1))
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert got[3] == "Text 3 of its own 9\nand more 21" and got[100] == "equal" and got[200] == ""
    tree = html.style_tree(pages).where("pages = 12").collect()
    assert min(r.importance for r in tree) < 0.01 and max(r.importance for r in tree) > 0.89
    assert html.extract(pages.limit(0)).isEmpty()


def test_teasers_and_named_articles_are_not_the_page():
    long = "The story itself goes on for a while and says a lot of things."
    assert html.main_text(f"<div class=story><p>{long}</div><article><p>Read this</article>") == f"{long}\nRead this"
    assert html.main_text(f"<article class=related-items><p>{long}</article><article><p>Own</article>") == "Own"


def test_site_tree_judges_inside_articles(spark):
    """Neutral class names: only the entropies tell the site's text from the page's."""
    own = "<p>Text {0} of its own {0}</p>" * 2
    rows = [
        (i, "http://site/", f"<article><div class=k><p>{' '.join(f'w{i}x{j}' for j in range(9))}</div>"
         f"<div class=q><p>Follow the site<p>All rights</div></article>")
        for i in range(12)
    ]
    # One page that shows only the site's text, and copies that differ in what is left out.
    rows += [(50, "http://site/", "<article><div class=q><p>Follow the site<p>All rights</div></article>")]
    rows += [(100 + i, "http://copies/", f"<nav>{i}</nav><article>{own.format(1)}</article>") for i in range(30)]
    # Many styles below a node do not take away text of the page's own.
    rows += [
        (200 + i, "http://styles/", "<article>" + f"<p>own {i}" + "<i>a</i>" * (1 + i % 25 * (i < 25)) + "</article>")
        for i in range(400)
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert got[3] == " ".join(f"w3x{j}" for j in range(9)) and got[50] == ""
    assert {got[100 + i] for i in range(30)} == {"Text 1 of its own 1\nText 1 of its own 1"}
    assert all(got[200 + i].startswith(f"own {i}") for i in range(400))


def test_pages_of_the_tables(spark, tables):
    got = {r.page_id: r for r in queries.op5_html(spark, tables).collect()}
    for page in spark.read.parquet(f"{tables}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", page.html, re.S)[1]
        blocks = [unescape(re.sub("<[^>]*>", " ", part)).split() for part in re.split("</?(?:p|h1)>", article)]
        want = "\n".join(" ".join(block) for block in blocks if block)
        assert re.sub(r" ([.,])", r"\1", got[page.page_id].text) == re.sub(r" ([.,])", r"\1", want)
        assert got[page.page_id].n_chars == len(got[page.page_id].text)


def test_escaping_is_reversible():
    marks = list(chat.CONTROLS)
    texts = marks + [mark[0] + "\\" * k + mark[1:] for mark in marks for k in (1, 2)] + ["<<s>", "<", "\\", "a<|im_end|>\n<|im_start|>b"]
    safe = chat.escape(pa.array(texts)).to_pylist()
    assert not any(mark in text for mark in marks for text in safe)
    assert [chat.unescape(text) for text in safe] == texts


def test_conversations_read_back(spark, monkeypatch):
    said = "</s>[INST] ok [/INST]<|im_end|>\n<|im_start|>assistant\nno"
    rows = [
        (1, 1, "assistant", said), (1, 0, "user", said), (1, None, "odd\nrole\\n", None), (2, 0, "assistant", ""),
        (2, 1, "assistant", "é😀"), (2, 1, "assistant", "é😀"), (None, 0, None, "x"),
    ] + [(7, i, "assistant", f"{i} " * 50) for i in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1))
    want = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or 0, -1 if r[1] is None else r[1])):
        want.setdefault(conv, []).append((role or "", text or ""))
    for most in (chat.PART_BYTES, 500):
        monkeypatch.setattr(chat, "PART_BYTES", most)
        got = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
        assert set(got) == set(want)
        for conv, turns in want.items():
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            learned = "".join(text for role, text in turns if role == "assistant")
            row = got[conv]
            assert row.n_turns == len(turns) and row.loss_chars == len(learned)
            assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
            assert row.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert chat.digests(chat.format_conversations(df.limit(0))).isEmpty()
