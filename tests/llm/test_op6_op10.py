"""Page extraction on known pages, token files by an exact round trip."""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import common, extract, tokens
from parcelflow.llm.common import table
from parcelflow.session import new_scratch


def test_articles_of_all_pages(spark, sf_dir):
    pages = {r.page_id: r for r in table(spark, sf_dir, "pages").collect()}
    rows = extract.extracted(table(spark, sf_dir, "pages")).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|h2)>|<br>", re.sub(r"</?b>", "", article))
        want = "\n".join(b for b in (re.sub(r"\s+", " ", html.unescape(x)).strip() for x in blocks) if b)
        assert r.text == want and r.n_chars == len(want) and r.url == pages[r.page_id].url


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("no tags at all &amp; more", "no tags at all & more"), ("<p>", ""), ("<<<>&#x41;", "<<<>A"),
        ("<body><div class='sidebar'>x</div><article><h1>T</h1><p>a  b\n c<p>d<br>e</article><form>f</form>", "T\na b c\nd e"),
        ("<main><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></main><footer>z</footer>", "one\ntwo\nx\ny"),
        ("<header>h</header><div><p>Long text here, and more of it.</p><p>Also this one.</p></div><div id='comments'><p>reader says</p></div>",
         "Long text here, and more of it.\nAlso this one."),
        ("<article><p>a</p><div class='ad'>buy</div><p>b<script>x<p></script></p><!-- c --></article>", "a\nb"),
    ],
)
def test_small_pages(page, want):
    assert extract.main_text(page) == want


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "content-with-ads", "menu-page", "cookie-recipe", "promo"])
@pytest.mark.parametrize("inner", ["article", "div"])
def test_layout_names_round_the_whole_text_cost_nothing(name, inner):
    page = (
        f"<body><nav><a href='/'>Home</a></nav><div class='{name}'><{inner}><p>A first paragraph of some length, with words.</p>"
        f"<p>And a second one, which is about as long.</p></{inner}></div><div class='{name}'>Buy this.</div><footer>f</footer></body>"
    )
    assert extract.main_text(page) == "A first paragraph of some length, with words.\nAnd a second one, which is about as long."


def test_long_reader_comments_are_left_out():
    said = "".join(f"<p>Reader {i} says a lot about this and that.</p>" for i in range(40))
    page = f"<body><div><p>The short article itself, two sentences.</p><p>Here they are.</p></div><div class='comments'>{said}</div></body>"
    assert extract.main_text(page) == "The short article itself, two sentences.\nHere they are."


def test_odd_pages(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>x</p>" * 20_000), (2, "u", "<div>" * 3000 + "deep"), (3, "u", "<p>x")]
    got = extract.extracted(spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")).collect()
    assert len(got) == 5 and sum(r.text == "" for r in got) == 2
    assert extract.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def _vocabulary():
    return str(pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"))


def _check(docs, rows):
    from tokenizers import Tokenizer

    tokenizer, start = Tokenizer.from_file(_vocabulary()), 0
    got = sorted(rows, key=lambda r: r.start)
    want = sorted(docs, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [r.doc_id for r in want]
    sums = []
    for r in got:
        assert r.start == start
        start += r.n_tokens
        sums.append((str(r.doc_id), r.n_tokens, r.ids_crc32))
    plain = []
    for d in docs:
        ids = np.array([*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 1], "<u4")
        plain.append((str(d.doc_id), len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(sums) == sorted(plain)


def test_token_files_round_trip(spark, sf_dir, odd_docs, no_docs):
    docs = table(spark, sf_dir, "documents")
    _check(docs.select("doc_id", "text").collect(), tokens.round_trip(docs, _vocabulary()).collect())
    _check(odd_docs.select("doc_id", "text").collect(), tokens.round_trip(odd_docs, _vocabulary()).collect())
    assert tokens.round_trip(no_docs, _vocabulary()).count() == 0


def test_pieces_are_encoded_as_whole_texts_are():
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(_vocabulary()), tokens.Encoder(_vocabulary(), "<u2")
    for text in ("I'm here;they'll  <|endoftext|>gó ́x", "a b c\x1cd\x85e", "ÀÉ 漢字😀 12x3\t\n''s", "e ́ ﬁ İstanbul"):
        whole = tokenizer.encode(text, add_special_tokens=False).ids
        ((ids, bounds),) = encoder.encode(pa.array([text, None, text, ""]))
        assert ids.tolist() == [*whole, 1, 1, *whole, 1, 1], text
        assert bounds.tolist() == [0, len(whole) + 1, len(whole) + 2, 2 * len(whole) + 3, 2 * len(whole) + 4]


def test_texts_in_blocks_and_bytes_that_are_no_text(monkeypatch):
    monkeypatch.setattr(common, "BLOCK_BYTES", 40)
    monkeypatch.setattr(tokens, "LEXICON", 3)
    encoder = tokens.Encoder(_vocabulary(), "<u2")
    texts = pa.array([f"some words of text number {i}, it's {'long ' * i}" for i in range(30)])
    found = [x for ids, bounds in encoder.encode(texts) for x in np.split(ids, bounds[1:-1])]
    assert [x[:-1].tolist() for x in found] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
    broken = pa.Array.from_buffers(pa.string(), 1, pa.array([b"ab\xff c"]).buffers())
    assert common.as_texts(broken).to_pylist() == ["ab\ufffd c"]


def test_rows_of_one_id_are_dealt_over_parts_and_read_by_as_many_tasks(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder = new_scratch(spark, "tokens-test")
    index, kind = tokens.write_corpus(docs, _vocabulary(), folder)
    sizes = [r.documents for r in index.collect()]
    assert len(sizes) == 8 and max(sizes) < 250
    read = tokens.read_corpus(index, folder, kind)
    _check(docs.collect(), read.collect())
    assert read.select(F.spark_partition_id().alias("task")).distinct().count() == 8
