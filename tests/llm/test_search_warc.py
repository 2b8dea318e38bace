"""Nearest neighbours against all pairs; WARC derivatives round trip."""

import base64
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainyard.llm import queries as Q
from chainyard.llm import warc_derivatives as C
from chainyard.llm.ann_mih import SubstringIndex, nearest_neighbours
from chainyard.session import shared_dir

from .conftest import SMALL


def exact(ids, x, query, k=20):
    score = (x * x[list(ids).index(query)]).sum(axis=1)
    other = [(-s, i) for s, i in zip(score, ids) if i != query]
    return [(i, -s) for s, i in sorted(other)[:k]]


def test_recall_against_brute_force(spark):
    import duckdb
    got = Q.op3_nearest_neighbours(spark, "/root/testdata/sf0.01").toPandas()
    z = duckdb.sql("select vec_id, embedding from '/root/testdata/sf0.01/embeddings.parquet'").fetchall()
    ids, x = [r[0] for r in z], np.array([r[1] for r in z], np.float64)
    assert set(got.query_id) == {i for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.groupby("query_id"):
        found = found.sort_values("rank")
        assert found["rank"].tolist() == list(range(1, 21))
        want, score = exact(ids, x, q), dict(exact(ids, x, q, len(ids)))
        assert np.allclose(found.score, [score[v] for v in found.vec_id], atol=1e-12)
        order = list(zip(-found.score, found.vec_id))
        assert order == sorted(order)
        hits += len({i for i, _ in want} & set(found.vec_id))
    assert hits / len(set(got.query_id)) / 20 >= 0.9


def test_pigeonhole_retrieves_every_code_within_the_radius():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 256, (500, 16), dtype=np.uint8)
    codes[100:200] = codes[:100] ^ (rng.random((100, 16)) < 0.2) * np.uint8(3)
    index, asked = SubstringIndex(codes), codes[:40]
    bits = np.bitwise_count(asked[:, None, :] ^ codes[None, :, :]).sum(axis=2)
    for radius in (0, 1, 2, 3, 5, 17, 50, 128):
        q, row = index.within(asked, radius)
        assert set(zip(q.tolist(), row.tolist())) == set(zip(*map(list, np.nonzero(bits <= radius))))


def search(spark, made, k=3, extra=False):
    df = spark.createDataFrame(made, "vec_id long, embedding array<float>")
    if extra:
        df = df.select("*", *[F.lit("x").alias(n) for n in ("v", "code", "rank", "score", "rb")])
    rows = nearest_neighbours(df, F.col("vec_id") % 20 == 0, k).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_odd_vectors_take_no_part(spark):
    made = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 5.0]), (4, None),
            (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [None, 1.0]),
            (9, []), (10, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (20, [0.0, 0.0]), (40, [0.0, 1.0]),
            (60, None)]
    want = {0: [(1, 1, 2.0), (2, 2, 2.0), (3, 40, 0.0), (4, 3, -1.0)],
            40: [(1, 3, 5.0), (2, 0, 0.0), (3, 1, 0.0), (4, 2, 0.0)]}
    assert search(spark, made, k=4) == want
    assert search(spark, made, k=4, extra=True) == want
    # all candidates, if fewer than k; none at all
    assert search(spark, made[:2], k=5) == {0: [(1, 1, 2.0)]}
    assert search(spark, made[:1]) == {} and search(spark, []) == {}
    assert search(spark, [(1, [1.0, 0.0])]) == {}


def test_crowd_of_equal_vectors(spark):
    rng = np.random.default_rng(0)
    made = [(i, [1.0, 2.0, 3.0] if i % 3 else rng.normal(size=3).tolist()) for i in range(300)]
    got = search(spark, made, k=5)
    first = [i for i in range(300) if i % 3][:6]
    assert [v for _, v, _ in got[20]] == [i for i in first if i != 20][:5]


PAGE = """<!DOCTYPE html><html lang="de"><head><meta charset="utf-8"><title>A &amp; B</title>
<style>p{margin:0}</style><script>var t="</p>";x()</script></head><body><!-- no <p> --><h1>Head</h1>
<p>One<br>two  <b>three</p><a href='/x?a=1&amp;b=2'>link</a> <a href=/y>y</a></body></html>"""


@pytest.fixture(scope="module")
def pages(spark):
    made = [(1, "http://a.example/1", PAGE), (2, None, None), (3, "u\r\nX: y", ""), (None, "v", "t"),
            (1, "http://a.example/1", PAGE), (4, "w", "<p>" + "long text " * 50_000)]
    return spark.createDataFrame(made, "page_id long, url string, html string").select(
        "*", F.lit("x").alias("key"), F.lit("x").alias("block"))


def test_derivatives(spark, pages):
    source = {r.record_id: r for r in C.responses(pages, "2024-01-01T00:00:00Z").collect()}
    got = C.derivatives(C.responses(pages, "2024-01-01T00:00:00Z")).collect()
    assert len(got) == 12 and len({r.record_id for r in got}) == 10
    for r in got:
        own = source[r.refers_to]
        head = dict(x.split(": ", 1) for x in r.header.strip().split("\r\n")[1:] if ": " in x)
        assert head["WARC-Refers-To"] == own.record_id
        assert head.get("WARC-Refers-To-Target-URI", "") == own.target_uri
        sha = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
        assert head["WARC-Block-Digest"] == sha(bytes(r.block))
        assert int(head["Content-Length"]) == len(r.block)
        if r.type == "conversion":
            assert head["X-Source-Payload-Digest"] == sha(bytes(own.payload))
        else:
            assert f"source-payload-digest: {sha(bytes(own.payload))}" in bytes(r.block).decode()
            assert "source-header: Content-Type: text/html; charset=utf-8" in bytes(r.block).decode()
    text = {(r.target_uri, r.type): bytes(r.block).decode() for r in got}
    assert text["http://a.example/1", "conversion"] == "A & B\nHead\nOne\ntwo three\nlink y"
    meta = text["http://a.example/1", "metadata"]
    for line in ("title: A & B", "language: de", "charset: utf-8", "outlink: /x?a=1&b=2", "outlink: /y"):
        assert line + "\r\n" in meta
    assert text["", "conversion"] == "" and len(text["w", "conversion"]) == 499_999


def test_files_round_trip(spark, pages):
    made = C.derivatives(C.responses(pages, "2024-01-01T00:00:00Z"))
    path = shared_dir(spark, "warc")
    assert C.write_warc(made, path).agg({"n_records": "sum"}).first()[0] == 12
    got = C.read_warc(spark, path).collect()
    want = sorted((r.record_id, r.refers_to, r.target_uri, C.digest(bytes(r.block)), len(r.block),
                   r.key is None) for r in made.collect())
    assert sorted((r.record_id, r.refers_to, r.target_uri, r.block_digest, r.n_bytes,
                   r.key is None) for r in got) == want
    assert all(r.sound for r in got)
    assert not C.parse_record(b"WARC/1.1\r\nWARC-Block-Digest: x\r\nContent-Length: 2\r\n\r\nab\r\n\r\n")["sound"]


def test_no_pages(spark, pages):
    none = C.derivatives(C.responses(pages.limit(0), "2024-01-01T00:00:00Z"))
    path = shared_dir(spark, "warc")
    C.write_warc(none, path)
    assert C.read_warc(spark, path).count() == 0


def test_registered_derivatives(spark):
    got = Q.op6_warc_derivatives(spark, SMALL).collect()
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").count()
    assert len(got) == 2 * pages and all(r.sound for r in got)


@pytest.mark.parametrize("piece", ["<a ", "<title>", "<a href=\"", "<html lang ", "<!--", "<script>",
                                   "</script ", "<", "<b '\">", "<a href=' ", "&", "<meta charset="])
def test_markup_left_open_takes_time_in_proportion(piece):
    import time
    spent = []
    for n in (20_000, 200_000):
        markup = (piece * n)[:n * 2]
        start = time.process_time()
        C.plain_text(markup)
        C.metadata(markup, "", "")
        spent.append(time.process_time() - start)
    assert spent[1] < 40 * max(spent[0], 0.01)


class Page:
    """Title, language, charset, links and text lines by the standard parser."""

    def __init__(self, markup):
        from html.parser import HTMLParser
        page, self.links, self.found, self.shown = self, [], {}, []
        self.title, self.hidden = None, []

        class Parser(HTMLParser):
            CDATA_CONTENT_ELEMENTS = ("script", "style")

            def handle_starttag(self, tag, attrs):
                attrs = dict(attrs)
                if page.hidden:
                    page.hidden += [tag] * (tag == page.hidden[0])
                elif tag in C.HIDDEN:
                    page.hidden.append(tag)
                    page.shown.append(" ")
                elif tag == "a" and "href" in attrs:
                    page.links.append(" ".join((attrs["href"] or "").split()))
                elif tag == "title" and page.title is None:
                    page.title = []
                for name, at, of in (("language", "lang", "html"), ("charset", "charset", "meta")):
                    if tag == of and attrs.get(at):
                        page.found.setdefault(name, attrs[at])
                page.shown += ["\n"] * (tag in C.BREAKS and not page.hidden)

            def handle_endtag(self, tag):
                if page.hidden:
                    page.hidden = [] if tag == page.hidden[0] else page.hidden
                    return
                if tag == "title" and page.title is not None:
                    page.found.setdefault("title", " ".join("".join(page.title).split()))
                page.shown += ["\n"] * (tag in C.BREAKS)

            def handle_data(self, data):
                if not page.hidden:
                    page.shown.append(data)
                    if page.title is not None and "title" not in page.found:
                        page.title.append(data)

            def handle_comment(self, data):
                page.shown.append(" ")

        parser = Parser(convert_charrefs=True)
        parser.feed(markup)
        parser.close()
        lines = (" ".join(x.split()) for x in "".join(self.shown).split("\n"))
        self.text = "\n".join(x for x in lines if x)


def test_pages_equal_the_standard_parser(spark):
    from chainyard.llm.common import table
    for r in table(spark, "/root/testdata/sf0.01", "pages").collect():
        want = Page(r.html or "")
        assert C.plain_text(r.html or "") == want.text, r.page_id
        fields = [x.split(": ", 1) for x in C.metadata(r.html or "", "", "").split("\r\n")[:-2]]
        assert [v for n, v in fields if n == "outlink"] == want.links
        assert {n: v for n, v in fields if n != "outlink"} == want.found


def test_quotes_open_tags_and_charsets():
    page = "<a title='x > y' HREF=/z>in</a><p>a < b<br/>c &lt; d<i title=\"open>e</i><p>f<q"
    assert C.plain_text(page) == "in\na < b\nc < de\nf<q"
    assert "outlink: /z" in C.metadata(page, "", "")
    assert C.decoded("é".encode("latin-1"), "Content-Type: text/html; charset=ISO-8859-1") == "é"
    assert C.decoded("é".encode(), "Content-Type: text/html; charset=no-such") == "é"
    assert C.decoded("é".encode(), "") == "é"
