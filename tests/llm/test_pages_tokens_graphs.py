"""Page extraction, merge-type tokens, token files and graphs."""

import os

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from tallyframe.llm import bpe, pages, tokenfiles, vamana
from tallyframe.llm.base import U64
from tallyframe.llm.queries import MODEL

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header><a href="/">Site name</a></header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div id="content"><article class="post"><h1>{title}</h1><p><b>First {n}<br>
<p>Second&nbsp;&amp; <i>la</i>st&lt;{n}&gt;   word<div class="ad">Buy</div><form>mail <input name="x>y"><button>Go</button></form>
<ul><li>one {n}<li>two {n}</ul><p>By the editors</article>
<section class="comments"><p>nice read {n}</p></section></div><aside>Top stories</aside><footer>&copy; us</footer></body></html>"""
WANT = "{title}\nFirst {n}\nSecond & last<{n}> word\none {n}\ntwo {n}"


def test_page_by_itself():
    got = pages.main_text(PAGE.format(title="T &#233;", n=3), None)
    assert got == WANT.format(title="T é", n=3) + "\nBy the editors"


@pytest.mark.parametrize(("page", "want"), [
    (None, ""), ("", ""), ("plain words", "plain words"), ("a < b &amp c <1 d", "a < b & c <1 d"), ("<p>open <b>bold", "open bold"),
    ("<div><p>x</p><script>while(1){'<p>'}", "x"), ("<!-- <p>no</p> --><p>yes", "yes"), ("<p a='>'>q<p b=\">\">r", "q\nr"), ("<div hidden>no</div><p>yes</p>", "yes"),
    ("<p>tail <a href='x", "tail"), ("<p>one</b> two</p>", "one two"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<nav>only</nav>", ""),
    ("<p>a\n  b\tc</p>", "a b c"), ("<main><header><h2>Head</h2>by me</header><p>body text that is long</main>", "Head\nbody text that is long"),
])
def test_odd_markup(page, want):
    assert pages.main_text(page, None) == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/!-pbdiv\"'= &;a\n", max_size=80))
def test_any_markup_is_read(page):
    pages.main_text(page, "/html/body")


@pytest.mark.parametrize(("before", "after"), [("<body>", ""), ("<body><div class='content with-sidebar'>", "</div>"), ("<body><div id='page-comments-on'>", "</div>"), ("<body><form id='aspnetForm'>", "</form>")])
def test_no_text_of_the_article_is_left_out(before, after):
    body = "".join(f"<p>{'a long paragraph of the article ' * 5}{i}</p>" for i in range(6))
    page = f"{before}<div class='cookie-notice'>We use cookies</div><article><h1>The title</h1><p>A lead</p><div class=body>{body}</div></article><ul><li><a href=x>Linked story</a></ul>{after}"
    tags, _, slots = pages.measured(page)
    slot = next(t.rpartition("<")[0] for t in tags if t.endswith("div.body<div"))
    want = "The title\nA lead\n" + "\n".join(f"{('a long paragraph of the article ' * 5)}{i}" for i in range(6))
    assert pages.main_text(page, None) == want == pages.main_text(page, slot)


def test_extract_by_host(spark):
    made = [(i, f"http://one.example/{i}", PAGE.format(title=f"Title {i}", n=i)) for i in range(30)]
    other = [(100 + i, f"https://u@Two.example:80/{i}", f"<body><div class=x1><p>menu text here</p></div><div class=x2><p>{'long text %d ' % i * 20}</p><p>more {i}</p></div></body>") for i in range(12)]
    odd = [(200, None, "<p>no url</p>"), (201, "http://one.example/n", None), (202, "http://one.example/e", ""), (3, "http://one.example/3", made[3][2])]
    odd += [(300, "http://one.example/x", "<body><p>another layout of the page</p></body>"), (None, "http://solo.example", "<article>solo</article>"), (400, "http://long.example", "<p>" + "word " * 100_000)]
    frame = spark.createDataFrame([(*r, "h", "m") for r in made + other + odd], "page_id long, url string, html string, host string, main string")
    rows = pages.extract(frame).collect()
    got = {(r.page_id, r.url): r.text for r in rows}
    assert len(rows) == len(made + other + odd) and all(r.n_chars == len(r.text) for r in rows)
    for i, url, _ in made:
        assert got[i, url] == WANT.format(title=f"Title {i}", n=i)  # the line of every page is the template's
    assert got[105, "https://u@Two.example:80/5"] == ("long text 5 " * 20).strip() + "\nmore 5"
    assert [got[k] for k in [(200, None), (201, "http://one.example/n"), (202, "http://one.example/e")]] == ["no url", "", ""]
    assert got[300, "http://one.example/x"] == "another layout of the page" and got[None, "http://solo.example"] == "solo"
    assert len(got[400, "http://long.example"]) == 499_999
    assert pages.extract(frame.limit(0)).collect() == []


def test_classes_of_a_host(spark):
    frame = spark.createDataFrame([(i, "h", PAGE.format(title=i, n=i)) for i in range(12)], "page_id long, host string, html string")
    t = pages.templates(frame).first()
    assert t.n_pages == 12 and t.n_classes >= 2 and t.main.endswith("/article.post") and t.frame[0] == "/html<html"
    assert any("By the editors" not in c and "#" in c for c in t.constants)


@pytest.mark.parametrize(("ranks", "once", "want"), [
    ([0, 1, 2], True, {0, 1, 2}), ([1, 2, 0, 3], True, {1, 2, 3}), ([2, 0, 1], True, {0, 1}), ([0, 1, 0, 1], False, {0, 1}), ([0, 1, 1, 0], False, set()), ([0, 0, 0], False, {0}),
])
def test_order_of_a_class_in_a_page(ranks, once, want):
    assert pages.in_order(ranks, once) == want


def test_template_is_of_ordered_and_nested_classes(spark):
    """Once-a-page elements whose order or gap differs between pages are of no valid class, so they are not of the template."""

    def page(i):
        swapped = ["<div class=a>first</div>", "<div class=b>second</div>"][:: 1 if i % 2 else -1]
        story = f"<article><h1>title {i}</h1><p>{f'words of story {i} ' * 30}</article>"
        roaming = f"<section class=s><h2>more {i}</h2></section>" if i % 5 < 3 else ""
        rows = "".join(f"<tr><td>{i} {k}</td><th>{k}</th></tr>" for k in range(2 + i % 3))
        middle = roaming + story if i % 2 else story + roaming
        return f"<html><body>{''.join(swapped)}<div id=m>{middle}</div><table>{rows}</table></body></html>"

    frame = spark.createDataFrame([(i, "h", page(i)) for i in range(40)], "page_id long, host string, html string")
    t = pages.templates(frame).first()
    assert t.frame == [
        "/html<html", "/html/body<body", "/html/body/div.a<div", "/html/body/div<div", "/html/body/div/article<article", "/html/body/div/article/h1<h1",
        "/html/body/div/article/p<p", "/html/body/table<table",
    ]
    assert t.main == "/html/body/div/article" and t.n_classes == 2  # the frame, and rows of the table with their cells
    assert t.n_slots == 7  # div.a; what has no fixed place in body; both cells; heading, paragraph; what has none in the middle
    one = pages.templates(frame.filter("page_id = 7")).first()
    assert "/html/body/div/section.s<section" in one.frame and "/html/body/div.b<div" in one.frame


def test_classes_are_those_of_equal_vectors():
    """Against a plain recount of vectors, and of what stands around each token."""
    made = ["<body><ul>" + "<li><a>x</a></li>" * k + "</ul>" + "<p><i>y</i></p>" * (k % 2) + "</body>" for k in (1, 2, 3, 4)]
    lists = [[v if kind == "open" else pages.fixed_token(e, v) for kind, e, v, _ in pages.parts(m)] for m in made]
    batch = pa.RecordBatch.from_pydict({"host": ["h"] * 4, "page_id": [1, 2, 3, 4], "tokens": lists})
    rows = pages.classes(next(pages._stat_batches(iter([batch]))).to_pandas())
    vectors = {t: tuple(x.count(t) for x in lists) for x in lists for t in x}
    assert set(rows["token"]) == set(vectors)
    for _, own in rows.groupby("group"):
        assert len({vectors[t] for t in own["token"]}) == 1 == own["up"].nunique()
    for t, up in zip(rows["token"], rows["up"]):
        assert not up or vectors[up] != vectors[t] and t.startswith(up.rpartition("<")[0])
    both = rows.merge(rows, on="up")
    assert all((vectors[a] == vectors[b]) == (g == k) for a, b, g, k in both[["token_x", "token_y", "group_x", "group_y"]].itertuples(index=False))


LIB = SentencePieceProcessor(model_file=MODEL)
PIECES = bpe.Pieces(bpe.read_model(MODEL))
PLAIN, DROPPED = bpe.Encoder(PIECES, 0.0), bpe.Encoder(PIECES, 0.2)
TEXTS = st.text(alphabet=st.one_of(st.sampled_from("the ing  \n\t,.'éß▁￾"), st.characters(exclude_categories=["Cs"])), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_round_trip_and_library(text):
    assert PIECES.decode(DROPPED.encode(text, 1).tolist()) == text
    ids = PLAIN.encode(text).tolist()
    assert PIECES.decode(ids) == text
    if "▁" not in text and "￾" not in text:
        assert ids == LIB.encode(text)


def test_one_by_one_and_together_agree():
    texts = ["therein lies the wordsmith's antidisestablishmentarianism", "ho" * 60, "a  b"]
    segments = sorted({s for t in texts for s in PIECES.segments(t)})
    keys = np.arange(1, len(segments) + 1).astype(U64) * U64(0x9E3779B97F4A7C15)
    for limit in (0, 1 << 61, 1 << 63):
        together = PIECES.merge_many(segments, keys, limit)
        assert together == [b"".join(map(PIECES.spell, PIECES._merge_long(s, keys[i : i + 1], limit))) for i, s in enumerate(segments)]


def test_dropout_varies_and_repeats():
    text = "segmentation of every single document in its own particular way " * 4
    one, two = DROPPED.encode(text, 0).tolist(), DROPPED.encode(text, 1).tolist()
    assert one != two != LIB.encode(text) and one == bpe.Encoder(PIECES, 0.2).encode(text, 0).tolist()
    assert bpe.Encoder(PIECES, 0.2, seed=99).encode(text, 0).tolist() != one
    all_dropped = bpe.Encoder(PIECES, 1.0).encode("the cat").tolist()
    assert [LIB.id_to_piece(i) for i in all_dropped] == list("▁the▁cat")


def test_encoded_documents(spark, documents, odd_texts):
    docs = documents(odd_texts)
    rows = bpe.encoded(docs, MODEL, check=True).collect()
    assert all(r.lossless and r.n_tokens == len(r.ids) for r in rows) and len(rows) == len(odd_texts)
    back = sorted((r.doc_id or 0, r.text) for r in bpe.decoded(bpe.encoded(docs, MODEL), MODEL).collect())
    assert back == sorted((i or 0, t or "") for i, t in odd_texts)
    assert all(r.lossless for r in bpe.round_trips(docs, MODEL).collect()) and bpe.encoded(docs.limit(0), MODEL).collect() == []
    assert sorted(map(str, bpe.encoded(docs.repartition(5), MODEL).collect())) == sorted(map(str, bpe.encoded(docs, MODEL).collect()))


def plain_counts(ids, end):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == end:
            out.append((start, i - start, True))
            start = i + 1
    return out + ([(start, len(ids) - start, False)] if start < len(ids) else [])


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
def test_separators_across_blocks(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    files = {"a": [], "b": [2], "c": [5, 6, 7], "d": [2, 2, 9, 2], "e": rng.integers(0, 9, 700).tolist(), "f": [3] * 200 + [2, 4], "g": (0x0202, 0x0200, 2)}
    for name, ids in files.items():
        (tmp_path / f"{name}.bin").write_bytes(np.array(ids, "<u2").tobytes())
    rows = tokenfiles.token_counts(tokenfiles.blocks(spark, f"file://{tmp_path}", block)).collect()
    for name, ids in files.items():
        own = sorted((r.doc_no, r.start, r.n_tokens, r.closed) for r in rows if r.file.endswith(f"/{name}.bin"))
        assert own == [(k, *x) for k, x in enumerate(plain_counts(list(ids), 2))]


def test_token_files_of_documents(spark, documents, odd_texts, tmp_path):
    docs = documents(odd_texts).coalesce(1)
    path = f"file://{tmp_path}/t"
    tokenfiles.write_token_files(docs, path, MODEL)
    got = tokenfiles.token_counts(tokenfiles.blocks(spark, path, 1 << 16)).orderBy("doc_no").collect()
    assert [r.n_tokens for r in got] == [len(LIB.encode(t or "")) for _, t in odd_texts] and all(r.closed for r in got)
    tokenfiles.write_token_files(docs.limit(0), path + "0", MODEL)
    assert tokenfiles.token_counts(tokenfiles.blocks(spark, path + "0")).collect() == []
    assert not any(f.endswith(".gz") for f in os.listdir(tmp_path / "t"))


def nearest_by_all(rows, k, every):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in good:
        if q % every == 0:
            d = sorted({(float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in good if i != q and len(y) == len(x)})
            out[q] = d[:k]
    return out


def test_nearest_on_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), float(i // 7), 1.0]) for i in range(40)] + [(200 + i, [3.0, 2.0, 1.0]) for i in range(30)]
    rows += [(100, None), (101, []), (102, [0.0, -0.0, 0.0]), (103, [1.0, None, 1.0]), (104, [nan, 1.0, 1.0]), (110, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(300, [1.0, 2.0]), (301, [1.0, 2.5]), (20, rows[20][1]), (400, [-0.0, 5.0, 1.0]), (401, [0.0, 5.0, 1.0]), (500, [9.0, 9.0, 9.0, 9.0])]
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], "vec_id long, embedding array<float>, vector string, shard int")
    got: dict = {}
    for r in vamana.nearest(frame, 10, 10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = {q: x for q, x in nearest_by_all(rows, 10, 10).items() if x}
    assert got == want
    assert vamana.nearest(frame.limit(0)).collect() == []


@pytest.mark.parametrize("kind", ["even", "clusters", "line"])
def test_recall(kind):
    rng = np.random.default_rng(2)
    data = {"even": lambda: rng.normal(size=(3000, 24)), "clusters": lambda: np.repeat(rng.normal(size=(30, 24)) * 9, 100, 0) + rng.normal(size=(3000, 24)), "line": lambda: np.sort(rng.random((3000, 1)), 0)}[kind]()
    edges, entry = vamana.build(data)
    assert (edges < len(data)).all() and edges.shape[1] == vamana.DEGREE
    queries = data[::30]
    got = vamana.beam_search(data, edges, entry, queries, vamana.SEARCH_BEAM)[0][:, :10]
    dist = ((queries[:, None] - data[None]) ** 2).sum(-1)
    best = np.argsort(dist, axis=1, kind="stable")[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(got.tolist(), best.tolist())]) >= 0.95


def test_recall_of_the_query_over_shards(spark, folder, monkeypatch):
    monkeypatch.setattr(vamana, "SHARD_ROWS", 300)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder.replace('0.001', '0.01')}/embeddings.parquet").collect()]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    index = vamana.build_index(frame.select("vec_id", frame.embedding.alias("vector")), 10, 150)
    assert index.count() == len(rows)
    asked = frame.filter("vec_id % 50 = 0").selectExpr("vec_id as query_id", "embedding as vector")
    got: dict = {}
    for r in vamana.search(index, asked, 10, query_rows=4).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = nearest_by_all(rows, 10, 50)
    assert sum(len(got[q] & {i for _, i in x}) for q, x in want.items()) >= 0.95 * sum(map(len, want.values()))


def test_every_occurrence_of_a_word_is_cut_in_its_own_way():
    def cuts(doc):
        written = "/".join(LIB.id_to_piece(i) for i in DROPPED.encode(" ".join(["segmentation"] * 300), doc).tolist())
        return written.split("▁")[1:]

    own = [cuts(doc) for doc in range(20)]
    assert all(len(set(x)) > 10 for x in own) and len(set(map(tuple, own))) == 20
    assert len({x[0] for x in own}) > 2  # the same place in documents


def test_trees_and_merges_agree():
    """What the trees lead to is what merging each occurrence by itself under its key gives."""
    texts = ["therein lies the wordsmith's antidisestablishmentarianism, the the  the", "ho" * 60, "the end of the lies", "日本 é the"] * 40
    enc = bpe.Encoder(PIECES, 0.3)
    for _ in range(2):  # with trees to be grown and with grown ones
        for doc, (text, got) in enumerate(zip(texts, enc.encode_many(texts, range(len(texts))), strict=True)):
            parts = PIECES.segments(text)
            base = bpe.mix(np.array([doc], np.int64).view(U64) ^ bpe.mix(np.array([enc.seed], np.int64).view(U64)))
            keys = bpe.mix(base + np.arange(len(parts)).astype(U64))
            assert got.tobytes() == b"".join(PIECES.merge_many(parts, keys, enc.limit))
    assert enc.trees.n > 100
