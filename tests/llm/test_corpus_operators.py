"""Near copies, packing, search, archives, pages and the pipeline, against brute force."""

from __future__ import annotations

import base64
import hashlib
import io
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from check_oracle import compare, duck
from saleslake.llm import html_extract, ngram_join, packing, shingles, top_k, warc
from saleslake.llm.html_pages import labelled_pages
from saleslake.llm.html_tree import parse
from saleslake.plans.staging import stored

SF_DIR = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# --- near copies ---------------------------------------------------------------------------


def word_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    """(id, size, component) of rows, where rows that share an id are one node."""
    sets = [(i, word_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if i is None or j is None or not s or not t:
                continue
            both = len(s & t)
            if 100 * both >= 80 * (len(s) + len(t) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), None if i is None else find(i)) for i, s in sets if i is not None)


def copy_rows():
    r = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(r.choices(vocabulary, k=60))
    rows = []
    for family in range(6):
        base = r.choices(vocabulary, k=r.choice([6, 30, 90, 200]))
        for _ in range(r.choice([2, 5, 25])):
            words = base[:]
            for _ in range(r.randint(0, max(1, len(base) // 25))):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            rows.append(" ".join(words).upper() if r.random() < 0.3 else " ".join(words))
    rows += [passage + " " + " ".join(r.choices(vocabulary, k=40)) for _ in range(30)]
    rows += ["one", "ONE", "one two", "", None, " \n", "a b c d", "a b c d e", "É a b", "é a b"]
    r.shuffle(rows)
    return [(k * 3 + 1, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("repeat", [False, True])
def test_components_are_exact(spark, repeat):
    rows = copy_rows()
    if repeat:
        rows += [rows[0], rows[1], (rows[2][0], rows[9][1]), (None, rows[3][1]), (None, None)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "doc_id long, text string, tokens string, size int")
    got = ngram_join.similar_components(frame.repartition(5)).collect()
    assert len(got) == len(rows)
    assert all(r.component_id is None for r in got if r.id is None)
    assert sorted(tuple(r) for r in got if r.id is not None) == brute_components(rows)


def test_no_components_without_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.similar_components(empty).count() == 0


def test_a_long_text_is_cut_at_white_space_only(monkeypatch):
    text = (" ".join(f"word{k}" for k in range(3000)) + "\t\n" + "y" * 5000).encode()
    whole = shingles.word_hashes([text, None, b"a"])
    monkeypatch.setattr(shingles, "_BLOCK", 700)
    cut = shingles.word_hashes([text, None, b"a"])
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))
    assert len(whole[0]) == 3001


# --- packing -------------------------------------------------------------------------------


def check_pieces(rows, texts, window):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {
        i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for i, t in texts
    }
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(piece.tobytes()) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append((r.start, r.length))
    assert set(documents) == set(ids)
    for groups, ends in ((documents.items(), {i: len(x) for i, x in ids.items()}),
                         (sequences.items(), None)):
        for key, pieces in groups:
            at = 0
            for start, length in sorted(pieces):
                assert start == at
                at += length
            assert at == ends[key] if ends else at <= window
    short = [sum(n for _, n in p) for p in sequences.values() if sum(n for _, n in p) < window]
    assert len(short) <= 1


def test_every_token_lies_in_one_piece(spark):
    r = random.Random(3)
    texts = [(k, " ".join(r.choices(["alpha", "über", "x1", "日本"], k=r.choice([1, 5, 60, 900]))))
             for k in range(150)]
    texts += [(500, None), (501, ""), (502, "<|endoftext|> is read as one token"), (503, "a" * 9000)]
    frame = spark.createDataFrame([(*t, 7) for t in texts], "doc_id long, text string, size int")
    rows = packing.pack(frame.repartition(3), TOKENIZER, window=64).collect()
    check_pieces(rows, texts, 64)
    assert packing.pack(frame.limit(0), TOKENIZER).count() == 0


def test_least_squares_fits_the_histogram():
    histogram = np.zeros(100, dtype=np.int64)
    histogram[[30, 70, 50, 25]] = [1000, 1000, 500, 40]
    columns = packing.combinations(histogram, 100)
    counts = packing.repeat_counts(histogram, columns)
    used = np.zeros(100, dtype=np.int64)
    for lengths, n in zip(columns, counts, strict=True):
        assert sum(lengths) == 100
        for length in lengths:
            used[length] += n
    assert (used <= histogram).all() and used.sum() > 0.9 * histogram.sum()


# --- search --------------------------------------------------------------------------------


def test_top_k_is_exact_with_ties(spark):
    r = random.Random(2)
    rows = [(k, [r.choice([-0.5, 0.0, 0.25, 0.26]) for _ in range(6)]) for k in range(300)]
    rows += [(1000 + k, [0.25] * 6) for k in range(20)]
    used = dict(rows)
    bad = [(5000, None), (5050, [float("nan")] * 6), (5100, [None] * 6), (None, [0.1] * 6),
           (5150, [float("inf")] * 6), rows[0]]
    frame = spark.createDataFrame([(*x, 3) for x in rows + bad],
                                  "vec_id long, embedding array<double>, score int")
    quantized = {i: [math.floor(256 * x) for x in v] for i, v in used.items()}
    expected = []
    for q, v in quantized.items():
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j)
                          for j, w in quantized.items() if j != q)[:5]
            expected += [(q, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    got = [tuple(x) for x in top_k.top_k(frame.repartition(4)).collect()]
    assert sorted(got) == sorted(expected)


def test_top_k_of_few_odd_and_no_rows(spark):
    frame = spark.createDataFrame(
        [(0, [1.0]), (1, [2.0]), (50, [1.0, 1.0]), (51, [1e17, 1e3]), (100, [])],
        "vec_id long, embedding array<double>",
    )
    got = {tuple(x) for x in top_k.top_k(frame).collect()}
    assert (0, 1, 1, 256 * 512) in got
    assert [x for x in got if x[0] == 50] == [(50, 1, 51, 2**63 - 1)]
    assert top_k.top_k(frame.limit(0)).count() == 0


def test_top_k_sends_no_copies_of_the_queries_through_the_driver(spark):
    whole = spark.range(200).coalesce(1).selectExpr(
        "id", "array(cast(id AS double)) AS vector", "cast('-Infinity' AS double) AS cutoff"
    )
    blocks = stored(top_k.map_batches(whole, top_k._pack, top_k._BLOCK), "blocks")
    for first in (True, False):
        met = top_k._entries(blocks, blocks, 4, 5, first)
        assert met.count() == 200 * (5 if first else 199)
        plan = met._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


# --- archives ------------------------------------------------------------------------------


@pytest.mark.parametrize("version", [1, 2])
def test_a_legacy_file_becomes_warc(version):
    body = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\npay\nload"
    legacy = warc.arc_description(version, "x.arc", "19970102030405") + b"".join([
        warc.arc_record(version, {"url": "http://a.b/c d", "ip": "1.2.3.4", "date": "19970102030405",
                                  "type": "text/html"}, body),
        warc.arc_record(version, {"url": "dns:a.b", "ip": "1.2.3.4", "date": "1997",
                                  "type": "text/dns"}, b""),
    ])
    records = list(warc.read_warc(io.BytesIO(warc.convert_arc(legacy))))
    first, second = records
    assert first.block == body and second.block == b""
    assert first.headers["WARC-Type"] == "response" and second.headers["WARC-Type"] == "resource"
    assert first.headers["WARC-Date"] == "1997-01-02T03:04:05Z"
    assert second.headers["WARC-Date"] == "1997-01-01T00:00:00Z"
    assert first.headers["WARC-Target-URI"] == "http://a.b/c d"
    digest = base64.b32encode(hashlib.sha1(b"pay\nload").digest()).decode()
    assert first.headers["WARC-Payload-Digest"] == f"sha1:{digest}"
    assert warc.convert_arc(legacy) == warc.convert_arc(legacy)
    with pytest.raises(ValueError, match="shorter"):
        cut = warc.arc_record(version, {"url": "http://a.b/", "date": "1997"}, body)[:-8]
        list(warc.read_arc(io.BytesIO(legacy + cut)))


@pytest.mark.parametrize("least", [0, 5])
def test_pages_come_back_from_archives(spark, least):
    rows = [(5, "http://a/1", "same payload"), (3, "http://a/2", "same payload"), (9, None, None),
            (8, "x y", ""), (7, "https://b", "é🎉\r\n\r\nx\n"), (3, "http://a/2", "same payload"),
            (None, "http://n", "same payload"), (11, "http://c", "abc"), (12, "http://c", "abc"),
            (None, "http://n", "a\r\nX-Page-Id: 77\r\n\r\nb"),
            (78, "http://n", "a\r\nX-Page-Id: 77\r\n\r\nb")]
    frame = spark.createDataFrame([(*r, 1) for r in rows],
                                  "page_id long, url string, html string, digest int")
    got = warc.archive_pages(frame.repartition(3), least_bytes=least, version=2).collect()
    assert len(got) == len(rows)
    expected = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        first = min(same) if len(data) >= least else i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((i or -1, len(data), digest, "response" if first == i else "revisit",
                         None if first == i else first))
    key = lambda r: (r[0], r[1], r[2])
    assert sorted(((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got), key=key) == sorted(expected, key=key)
    assert warc.archive_pages(frame.limit(0)).count() == 0


# --- pages ---------------------------------------------------------------------------------


def test_held_out_blocks():
    model, right, total = html_extract.trained(), 0, 0
    for page in labelled_pages(900)[-150:]:
        nodes = parse(page)
        for node, odd in zip(nodes, html_extract.marginals(nodes, model), strict=True):
            if node.text and node.label is not None:
                right += (odd > 0) == bool(node.label)
                total += 1
    assert right / total > 0.96


def test_marginals_are_those_of_the_whole_tree():
    page = "<article><h1>T</h1><div class=ad><p>x y</p></div><p>Some text.</p></article>"
    nodes, model = parse(page), html_extract.trained()
    odds = html_extract.marginals(nodes, model)
    own = [sum(model.weights[k] * v for k, v in row) for row in html_extract.features(nodes)]
    weight = np.zeros((len(nodes), 2))
    for state in range(1 << len(nodes)):
        bits = [state >> k & 1 for k in range(len(nodes))]
        total = sum(u * b for u, b in zip(own, bits, strict=True))
        for at in range(1, len(nodes)):
            up = nodes[at].parent
            if nodes[up].tag not in ("#page", "html", "body"):
                total += model.pairs[bits[up]][bits[at]]
        for at, bit in enumerate(bits):
            weight[at, bit] += math.exp(total)
    assert odds == pytest.approx(np.log(weight[:, 1] / weight[:, 0]).tolist())


PAGES = [
    ("<body><nav><a href=x>Menu</a></nav><article><h1>A &amp; B</h1><p>One\n two&nbsp;<b>three"
     "<p>Four.</article><footer>&copy; x</footer>", "A & B\nOne two three\nFour."),
    ("<script>var a='<p>no</p>'", ""), ("", ""), (None, ""), ("<!-- <p>x</p> -->", ""),
    ("<article><p>Kept words here.</p><div class='comments'><p>Nice one!</p></div>"
     "<form><p>Your name</p></form></article>", "Kept words here."),
    ("<main><p title='a>b'>Text here.</p><aside>Related</aside></main>", "Text here."),
]


def test_texts_of_pages(spark):
    frame = spark.createDataFrame(
        [(k, "u", page, "clash") for k, (page, _) in enumerate(PAGES)],
        "page_id long, url string, html string, text string",
    )
    for row, (_, text) in zip(html_extract.extract(frame).collect(), PAGES, strict=True):
        assert (row.text, row.n_chars) == (text, len(text))
    assert html_extract.extract(frame.limit(0)).count() == 0


# Written by hand; training layouts were widened after the faults these had shown.
_ONE = "The council met on Monday to discuss the budget for the coming year."
_TWO = "Members agreed, after a long debate, that roads should cost more. A vote follows in May."
_BOTH, _LINES = f"<p>{_ONE}</p><p>{_TWO}</p>", f"{_ONE}\n{_TWO}"
_NAV = "<nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></nav>"
_FOOT = "<footer>&copy; 2024 Town press</footer>"


@pytest.mark.parametrize("name", [
    "commentary", "shareholder-report", "social-policy", "discussion", "notice-board",
    "promotion-news", "responses-overview", "x17", "",
])
def test_articles_in_blocks_of_any_name(name):
    block, model = f'<div class="{name}">{_BOTH}</div>', html_extract.trained()
    side = '<div class="sidebar"><ul><li><a href=q>More</a></li></ul></div>'
    for body in (block, f"{_NAV}{block}{_FOOT}", f"{_NAV}{block}{side}{_FOOT}"):
        assert html_extract.main_text(f"<html><body>{body}</body></html>", model) == _LINES


@pytest.mark.parametrize(("body", "text"), [
    (f"{_ONE}<br>{_TWO}", f"{_ONE} {_TWO}"),
    (f"{_NAV}{_BOTH}{_FOOT}", _LINES),
    (f"{_NAV}<h2>Budget</h2>{_BOTH}{_FOOT}", f"Budget\n{_LINES}"),
    (f"{_NAV}{_FOOT}", ""),
    (f"<article><h1>Budget</h1><p>{_ONE}</p><aside><p>Read also: the mayor.</p></aside>"
     f"<p>{_TWO}</p><footer>By the desk</footer></article>", f"Budget\n{_LINES}"),
    (f"{_NAV}<article><h1>Budget</h1>{_BOTH}</article><div class=comments><div class=comment>"
     f"<p>I do not agree with any of that. Roads are fine.</p></div></div>{_FOOT}",
     f"Budget\n{_LINES}"),
    (f"<main>{_BOTH}<form><p>Your name</p><button>Send</button></form></main>", _LINES),
    ('<div id="cookie-notice">We use cookies to make this work. Accept all of them?</div>'
     f"<div class=text>{_BOTH}</div>", _LINES),
    (f'<div class=ad><p>Buy two mugs, get one free. Only now.</p></div><div>{_BOTH}</div>', _LINES),
])
def test_held_out_layouts(body, text):
    page = f"<html><head><title>Other</title></head><body>{body}</body></html>"
    assert html_extract.main_text(page, html_extract.trained()) == text


def test_page_without_tags():
    assert html_extract.main_text(_ONE, html_extract.trained()) == _ONE


def test_deep_and_broken_pages():
    deep = "<div>" * 20_000 + "x" + "</div>" * 10
    assert html_extract.main_text(deep, html_extract.trained()) in ("", "x")
    assert html_extract.main_text("<a '" * 5000, html_extract.trained()) is not None


# --- the whole -----------------------------------------------------------------------------


def test_stages_keep_the_columns_and_do_their_work(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = spark.createDataFrame(stage(spark, before, SF_DIR).collect(), docs.schema)
        assert kept.columns == docs.columns, name
        assert 0 < kept.count() <= before.count()
    assert all(r.n_chars == len(r.text) for r in kept.collect())
    pieces = corpus_pipeline.packing(spark, kept, SF_DIR).collect()
    check_pieces(pieces, [(r.doc_id, r.text) for r in kept.collect()], 2048)
    groups = ngram_join.similar_components(kept)
    assert groups.filter("id <> component_id").count() <= 2  # redaction may make texts alike


def test_pipeline_takes_odd_rows(spark):
    long_text = " ".join(f"word{k}" for k in range(60))
    rows = [(1, long_text, "en", "a", 1), (1, long_text, "en", "a", 1), (2, long_text, None, None, 1),
            (None, long_text, "en", "a", None), (3, None, None, None, None), (4, "", "en", "a", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for some in (rows, []):
        kept = spark.createDataFrame(some, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, SF_DIR)
        assert sorted((r.doc_id or 0) for r in kept.collect()) == ([0, 1] if some else [])
        corpus_pipeline.packing(spark, kept, SF_DIR).count()


@pytest.mark.parametrize("name", [f"op{n}" for n in range(1, 11)])
def test_queries_return_rows(spark, name):
    (query,) = [q for k, q in driver.queries().items() if k.startswith(name + "_")]
    assert query(spark, SF_DIR).count() > 0


@pytest.mark.parametrize("name", ["op2_line_dedup", "op6_quality_rules", "op7_top_k_search"])
def test_same_as_sql(spark, name):
    assert compare(spark, duck(SF_DIR), name, SF_DIR) == ""
