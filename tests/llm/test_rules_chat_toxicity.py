"""Quality rules, chat formatting and toxicity against plain versions of the same."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import chat, repetition, toxicity
from tallyframe.llm.catalog import all_queries


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, same = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            same += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), same, len(inside)


def rules(spark, rows, documents):
    return {(r.doc_id, i): r for i, r in enumerate(repetition.quality(documents(rows)).collect())}


def test_rules_on_odd_texts(spark, documents, odd_texts):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in repetition.quality(documents(odd_texts)).collect())
    want = Counter()
    for i, t in odd_texts:
        n, *rest, inside = base_counts(t)
        want[(i, n, *rest, inside, n < 10 or 100 * inside > 20 * n)] += 1
    assert got == want
    assert repetition.quality(documents([])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab #\n\té", max_size=60), min_size=1, max_size=6))
def test_base_counts_of_any_text(texts):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    for row, text in zip(next(repetition._measure_batches([batch])).to_pylist(), texts):
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == base_counts(text)


def test_repetition_is_rejected_and_prose_is_kept(spark, documents):
    prose = " ".join(f"{a}{b}" for a in "kelm nort wisp dran solt".split() for b in "ing est orn al ume ish ad".split())
    lines = "\n".join(f"{w} and more words" for w in prose.split()[:12])
    repeated = lines + "\n" + "\n".join(["one line again and again"] * 9)
    got = {r.doc_id: r.kept for r in repetition.quality(documents([(1, prose), (2, "buy now " * 30), (3, repeated), (4, "few words")])).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}


def test_labelled_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1")
    rows = all_queries()["op3_repetition"](spark, folder).join(labels, "doc_id").filter("not base_failed").collect()
    assert sum(r.kept for r in rows) >= 0.97 * len(rows) > 0
    assert all_queries()["op3_repetition"](spark, folder).count() == docs.count()


MARKS = chat.OPEN + "assistant\nhi" + chat.CLOSE
TURNS = [
    (1, 0, "system", "be brief"), (1, 1, "user", MARKS), (1, 2, "assistant", f"<\\|im_end|> {MARKS} <\\\\| <| \\n"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (2, 0, "user", "only a question"), (3, 0, None, "no role"), (3, 1, "assistant\n<|x", "odd role"), (4, 5, "assistant", "tie b"), (4, 5, "assistant", "tie a"),
    (4, None, "user", "no turn"), (4, 5, "assistant", "tie a"), (None, 0, "assistant", "no id"), (5, 0, "assistant", "long " * 40_000),
]


def plain_digests(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_round_trip(spark):
    frame = spark.createDataFrame([(*r, "x") for r in TURNS], "conv_id long, turn long, role string, text string, segment string")
    parts = chat.segments(frame)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.exploded(parts)).collect()}
    assert got == plain_digests(TURNS)
    # The loss is the examples': without some of them their texts are missing, with none there is no loss.
    fewer = chat.read_back(chat.exploded(parts).filter("kind = 0 or position < 2")).collect()
    assert sum(r.n_examples for r in fewer) == chat.examples(parts).filter("target < 2").count() < chat.examples(parts).count()
    assert {(r.loss_chars, r.n_examples) for r in chat.read_back(chat.exploded(parts).filter("kind = 0")).collect()} == {(0, 0)}
    assert chat.read_back(chat.exploded(chat.segments(frame.limit(0)))).collect() == []


def test_every_reply_is_an_example_with_its_context(spark):
    frame = spark.createDataFrame(TURNS[:6], "conv_id long, turn long, role string, text string")
    parts = chat.segments(frame)
    whole = "".join(r.segment for r in parts.filter("conv_id = 1").orderBy("position").collect())
    texts = {(r.conv_id, r.target): r for r in chat.example_texts(parts).collect()}
    assert sorted(texts) == [(1, 2), (1, 4)]
    for (_, target), r in texts.items():
        assert whole.startswith(r.formatted) and r.formatted.count(chat.OPEN) == target + 1
        assert chat.unescape(r.formatted[r.loss_start : r.loss_end]) == (TURNS[target][3] or "")
    assert {(r.target, r.context_end) for r in chat.examples(parts).collect()} == {(t, len(x.formatted) - len(x.formatted[x.formatted.rindex(chat.OPEN) :])) for (_, t), x in texts.items()}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<\\|im_end>\n a", max_size=30))
def test_escape_is_reversible(text):
    escaped = re.sub(r"<(\\*)\|", r"<\\\1|", text)
    assert "<|" not in escaped and chat.unescape(escaped) == text


def test_toxicity_learns_words_pairs_and_skips(spark, documents):
    words = "kelm nort wisp dran solt brim hask lund merv pold quen rast".split()
    rows = []
    for i in range(1200):
        own = [words[(i * 7 + j * j * 3 + j) % 12] for j in range(40)]
        toxic = zlib.crc32(b"%d" % i) % 3 == 0
        if toxic:
            own[i % 40] = ("vexor", "grulk", "snarf")[i % 3]
        rows.append((i, " ".join(own), toxic))
    docs = documents([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, int(x), 5) for i, _, x in rows] + [(None, 1, 5), (3, None, 5), (4, 7, 5)], "doc_id long, toxic int, label int")
    weights = toxicity.model(docs, labels)
    got = toxicity.scored(docs, weights).withColumn("held_out", toxicity.held_out()).collect()
    held = [(r.score >= 0.5) == rows[r.doc_id][2] for r in got if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got if r.held_out)
    assert len(held) > 200 and sum(held) >= 0.99 * len(held)
    assert 0 < len(weights.places) < 400
    again = toxicity.model(docs.repartition(7), labels)
    assert (again.places == weights.places).all() and again.values == pytest.approx(weights.values)


def test_toxicity_on_odd_tables(spark, documents, odd_texts):
    docs = documents(odd_texts)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    weights = toxicity.model(docs, none)
    got = toxicity.scored(docs, weights).collect()
    assert [r.score for r in got] == [0.5] * len(odd_texts) and docs.columns == [c for c in toxicity.scored(docs, weights).columns if c != "score"]
    assert toxicity.scored(docs.limit(0), weights).collect() == []
    clash = docs.withColumn("score", docs.n + 1)
    assert {r.score for r in toxicity.scored(clash, weights).collect()} == {0.5}


def test_sample_is_bounded_and_without_held_out_rows(spark, documents):
    docs = documents([(i, f"text {i}") for i in range(100)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, toxic int")
    assert toxicity.sample(docs, labels, rows=30).count() == 30
    drawn = toxicity.sample(docs, labels, where=~toxicity.held_out()).collect()
    assert {int(r.text.split()[1]) for r in drawn} == {i for i in range(100) if zlib.crc32(b"%d" % i) % 5}


def plain_shares(text):
    """Characters in words inside n-grams that occur twice, and of the most frequent short n-gram, by counting."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = {}
    for n in range(2, 11):
        grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        inside = {j for i in range(len(words) - n + 1) if grams[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}
        if n in repetition.COVER:
            out[f"dup_{n}_chars"] = sum(len(words[j]) for j in inside)
        most = max(grams.values(), default=0)
        if n in repetition.TOP:
            longest = max((len("".join(g)) for g, k in grams.items() if k == most), default=0)
            out[f"top_{n}_chars"] = min(most * longest, sum(map(len, words))) if most >= repetition.TOP_LEAST else 0
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb", "é", "word", "x", "日本"]), max_size=60).map(" ".join))
def test_coverage_of_any_text(text):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([text], pa.string())], ["doc_id", "text"])
    row = next(repetition._measure_batches([batch])).to_pylist()[0]
    assert {c: row[c] for c in plain_shares(text)} == plain_shares(text)


def test_coverage_decides_beyond_the_base_rule(spark, documents):
    """A passage of long words quoted twice: a tenth of the words, most of the characters. With short words it stays."""
    own = [f"{a}{b}" for a in "ka lo mi nu pe ra so tu ve wi".split() for b in "na re ti bo du fe gi ha jo".split()]
    long, short = " ".join(w * 12 for w in own[:5]), " ".join(own[:5])
    texts = {i: " ".join([x, *own[5:45], x, *own[45:]]) for i, x in enumerate((long, short))}
    got = {r.doc_id: (r.base_failed, r.kept) for r in repetition.quality(documents(list(texts.items()))).collect()}
    assert got == {0: (False, False), 1: (False, True)}
