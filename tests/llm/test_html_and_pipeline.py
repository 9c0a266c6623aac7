from __future__ import annotations

import html
import re
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from promoledger.llm import html_text, simhash
from promoledger.llm.common import fold, table
from promoledger.session import stage
from tests.llm.data import SMALL, edge_docs, empty_docs, write_tables
from tests.llm.test_near_duplicates import least_reachable, plain_fingerprint

NONE = np.zeros(0, np.int64)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("a<b>b</b> c", "ab c"),
        ("<p>x<p>y<script>var a='<p>no</p>'</script>z<!-- c --> 1 < 2 &amp;lt;", "x y z 1 < 2 &lt;"),
        ("<header>Site</header><main><article><header><h1>T</h1><p>by</p></header><p>One &amp; two<br>three</p><aside>x</aside><div class='comments'><article>c</article></div></article>more</main>", "T One & two three"),
        ("<div class='has sidebar'><article>in</article></div><footer>f</footer>", "in"),
        ("<article>a<form>q</form>b<nav>n</nav><div class=ad>AD</div>c<span hidden>h</span><i>d</i>e", "a b c de"),
        ("<body class='sidebar'><main>m<div id=cookie-notice>ok</div></main><div>o</div>", "m"),
        ("<article>1</article><article>2\n\n 3&nbsp;4</article>", "1 2 3 4"),
        ("<style>x", ""),
        ("<article>cut <a href='", "cut"),
    ],
)
def test_structure(page, text):
    assert html_text.main_text(page, NONE) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article><h1 class="post-header">Title</h1><p>Body text</p>', "Title Body text"),
        ('<article><div class="form-group-theory"><p>On groups</p></div></article>', "On groups"),
        ('<article><p>a</p><div class="search-results-discussion"><p>Body one</p></div><p>b</p></article>', "a Body one b"),
        ('<article><p class="share">of all</p><h2 id="comments">Comments on a law</h2><div class="site-footer">f</div><ul class="main-nav"><li>n</ul></article>', "of all Comments on a law"),
        ('<article>x<div class="ad-banner">ad</div><section id="comment_list">c</section><div class="cookie-notice top">k</div>y</article>', "x y"),
    ],
)
def test_parts_of_names_alone_drop_nothing(page, text):
    assert html_text.main_text(page, NONE) == text


def test_repeats_decide_doubtful_blocks_of_articles(spark):
    """A block whose name only contains a telling word goes where the host's pages repeat it, and stays where they do not."""
    shared = '<div class="post-footer-links"><p>read more of our stories on this very site every day</p></div>'
    page = lambda i: f"<nav>Home About Us</nav><article><h1>T{i}</h1><p>own text {i}</p><div class='post-header-note'>written by the author {i} in year {i} at place {i}</div>{shared}<p>the same closing words that every author here writes at the end</p></article>"
    rows = spark.createDataFrame([(i, "http://h.com/", page(i)) for i in range(12)], "page_id long, url string, html string")
    for r in html_text.extract(rows).collect():
        i = r["page_id"]
        assert r["text"] == f"T{i} own text {i} written by the author {i} in year {i} at place {i} the same closing words that every author here writes at the end"
    alone = html_text.extract(rows.limit(1)).collect()[0]
    assert "our stories on this very site" in alone["text"]


def test_windows_of_suffix_arrays_equal_a_plain_count():
    rng = np.random.default_rng(4)
    streams = [html_text.token_numbers([str(x) for x in rng.integers(0, 3, rng.integers(0, 40))]) for _ in range(30)]
    names, pages = html_text.repeats(streams, 4)
    want = defaultdict(set)
    for page, stream in enumerate(streams):
        for name in html_text.window_names(stream, 4).tolist():
            want[name].add(page)
    assert dict(zip(names.tolist(), pages.tolist(), strict=True)) == {k: len(v) for k, v in want.items()}
    order, rank = html_text.suffix_order(streams[0], 4)
    assert sorted(order.tolist()) == list(range(len(streams[0]))) and (np.diff(rank[order]) >= 0).all()


def test_articles_are_found_whole(spark):
    found = {r["page_id"]: r for r in html_text.query(spark, SMALL).collect()}
    rows = table(spark, SMALL, "pages").collect()
    assert len(found) == len(rows)
    for row in rows:
        inner = re.search(r"<article>(.*?)</article>", row["html"], re.DOTALL)[1]
        parts = [html.unescape(re.sub(r"<[^>]+>", "", p)) for p in re.split(r"</?(?:p|h1|br)>", inner)]
        want = " ".join(" ".join(parts).split())
        assert found[row["page_id"]]["text"] == want and found[row["page_id"]]["n_chars"] == len(want)


def test_repeats_go_where_no_structure_tells(spark, monkeypatch):
    monkeypatch.setattr(html_text, "CHUNK_TOKENS", 60)
    own = lambda i: " ".join(f"own{i}x{j}" for j in range(12))
    rows = [(i, f"http://u@H.com:80/{i}", f"<div>Home About Contact Imprint Press Jobs</div><div>{own(i)}</div><div>all rights of this site reserved to nobody</div>", "x") for i in range(20)]
    rows += [(100 + i, "http://h.com/copy", rows[3][2], "x") for i in range(30)]
    rows += [(200, "http://other.com/", rows[0][2], "x"), (201, None, None, None), (202, "no url", "", "x"), (None, "http://h.com/", "<article>a</article>", "x"), (3, rows[3][1], rows[3][2], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    found = html_text.extract(pages).collect()
    assert len(found) == len(rows)
    text = {r["page_id"]: r["text"] for r in found}
    assert all(text[i] == own(i) for i in range(20)) and all(text[100 + i] == own(3) for i in range(30))
    assert text[200].startswith("Home") and text[201] == "" and text[202] == "" and text[None] == "a"
    assert html_text.extract(pages.limit(0)).count() == 0


def test_every_stage_against_a_plain_version(spark):
    docs = table(spark, SMALL, "documents")
    for name, step in corpus_pipeline.STAGES:
        out, _ = stage(step(spark, docs, SMALL), "test-stage")
        before = {r["doc_id"]: r.asDict() for r in docs.collect()}
        if name != "packing":
            assert out.columns == docs.columns
            after = {r["doc_id"]: r.asDict() for r in out.collect()}
        if name == "quality classifier":
            good = {r["doc_id"] for r in table(spark, SMALL, "labels").where("quality = 1").collect()}
            assert good <= set(after) and len(after) < len(before) and all(before[i] == after[i] for i in after)
        elif name == "language ID":
            assert set(after) == {i for i, r in before.items() if re.search(r"[^\W\d_]", r["text"] or "")}
        elif name == "line dedup":
            pages, seen = defaultdict(int), defaultdict(set)
            for i, r in before.items():
                pages[r["source"]] += 1
                for line in {x.strip(" ") for x in r["text"].split("\n")} - {""}:
                    seen[r["source"], line].add(i)
            bad = {k for k, v in seen.items() if len(v) >= 3 and len(v) / pages[k[0]] > 0.1}
            for i, r in before.items():
                want = "\n".join(x for x in r["text"].split("\n") if (r["source"], x.strip(" ")) not in bad)
                assert after[i]["text"] == want and after[i]["n_chars"] == (len(want) if want != r["text"] else r["n_chars"])
        elif name == "SimHash near-dedup":
            values = {i: plain_fingerprint(r["text"]) for i, r in before.items()}
            ids = sorted(values)
            roots = least_reachable([(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (values[a] ^ values[b]).bit_count() <= 3], ids)
            assert set(after) == set(roots.values())
        else:
            words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for i, r in before.items()}
            packed = defaultdict(int)
            for r in out.collect():
                packed[r["doc_id"]] += r["length"]
            assert packed == words
        docs = out


def test_run_equals_the_stages_one_by_one(spark):
    docs = table(spark, SMALL, "documents")
    for _, step in corpus_pipeline.STAGES:
        docs, _ = stage(step(spark, docs, SMALL), "test-stage")
    assert sorted(map(tuple, docs.collect()), key=str) == sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect()), key=str)


def test_stages_bear_edges(spark, tmp_path):
    folder = write_tables(spark, tmp_path, labels=table(spark, SMALL, "labels"))
    docs = edge_docs(spark).unionByName(table(spark, SMALL, "documents").select("doc_id", "text", "lang", "source", "n_chars"), allowMissingColumns=True)
    for start in (docs, empty_docs(spark)):
        now, _ = stage(start, "test-stage")
        for name, step in corpus_pipeline.STAGES:
            out, _ = stage(step(spark, now, folder), "test-stage")
            assert name == "packing" or out.columns == start.columns
            now = out
        if start is not docs:
            assert now.count() == 0


def test_repeated_rows_leave_one(spark):
    rows = edge_docs(spark).where("doc_id = 2 or doc_id is null")
    kept = corpus_pipeline.near_duplicate_stage(spark, rows, SMALL).collect()
    assert sorted((r["doc_id"] or 0, r["text"] is None) for r in kept) == [(0, False), (0, True), (2, False)]


def test_hold_out_folds(spark):
    import zlib

    ids = spark.createDataFrame([(0,), (17,), (123456,), (None,)], "doc_id long")
    for r in ids.withColumn("f", fold("doc_id", 5)).collect():
        assert r["f"] == zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert simhash.MOST_BITS == 3
