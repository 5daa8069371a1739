"""Jaccard join, suffix dedup, components and mixing against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from tallyframe.llm import components, mixing, setjoin, suffixes
from tallyframe.llm.base import U64, id_filter, rows_in_filter


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()


def plain_components(rows, width, percent):
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(i, shingles(t, width)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def family(rng, base, n, edits):
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize(("width", "percent", "seed"), [(3, 90, 1), (5, 80, 2), (1, 50, 3)])
def test_components_of_near_copies(spark, documents, width, percent, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    texts = []
    for size in (8, 40, 150):
        base = [rng.choice(vocabulary) for _ in range(size)]
        texts += family(rng, base, 25, max(1, size // 12))
        texts += family(rng, passage + base, 4, 2)
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += ["two words", "TWO words", "words two", "one", "One", "Éa b c", "éa b c"]
    rows = list(enumerate(texts, 100))
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setjoin.jaccard_components(documents(rows), width, percent).collect()}
    assert got == plain_components(rows, width, percent)


def test_many_blocks_and_parts_change_nothing(spark, documents, monkeypatch):
    rng = random.Random(9)
    rows = list(enumerate(family(rng, [f"w{i}" for i in range(60)], 120, 9)))
    want = plain_components(rows, 3, 90)
    monkeypatch.setattr(setjoin, "BLOCK", 5)
    monkeypatch.setattr(setjoin, "VISITORS", 3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setjoin.jaccard_components(documents(rows), 3, 90).collect()}
    assert got == want


def test_join_on_odd_texts(spark, documents, odd_texts):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in setjoin.jaccard_components(documents(odd_texts), 3, 90).collect())
    known = {i: t for i, t in odd_texts if i is not None}
    want = plain_components(sorted(known.items()), 3, 90)
    assert got == sorted([(i, *want[i]) for i, _ in odd_texts if i is not None] + [(0, len(shingles(odd_texts[10][1], 3)), None)])
    assert setjoin.jaccard_components(documents([])).collect() == []
    stay = setjoin.one_of_each(documents(odd_texts), 3, 90)
    assert sorted(r.doc_id or 0 for r in stay.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10, 11] and "pattern" in stay.columns


def test_one_id_with_two_texts(spark, documents):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    got = setjoin.jaccard_components(documents([(5, a), (5, b), (6, a), (7, b)]), 3, 90).collect()
    assert {r.component_id for r in got} == {5}


def test_group_bound_and_members_are_exact():
    rng = np.random.default_rng(0)
    group = setjoin.Group(70)
    sets = [np.unique(rng.integers(0, 60, 30)).astype(U64) for _ in range(40)]
    for i, s in enumerate(sets):
        group.add(i, s)
    group.close()
    for _ in range(50):
        q = np.unique(rng.integers(0, 70, 30)).astype(U64)
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(q, s)) >= 70 * len(np.union1d(q, s))]
        assert group.linked(q).tolist() == want


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(0, 90)] + [(200, 200 + i) for i in range(1, 60)] + [(300, 300), (7, 3), (None, 5), (401, 400), (400, 401)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = dict.fromkeys(range(91), 0) | dict.fromkeys(range(200, 260), 200) | {400: 400, 401: 400}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_filter_of_ids_never_misses(spark):
    ids = spark.range(0, 3000, 3).withColumnRenamed("id", "x")
    bits = id_filter(ids, "x")
    every = spark.range(0, 6000).withColumnRenamed("id", "x")
    rows, others = rows_in_filter(every, bits, "x"), rows_in_filter(every, bits, "x", inside=False)
    assert ids.join(rows, "x", "left_anti").count() == 0 and rows.count() < 1100 and rows.count() + others.count() == 6000
    none = spark.createDataFrame([(None,)], "x long")
    assert rows_in_filter(none, bits, "x").count() == 0 and rows_in_filter(none, bits, "x", inside=False).count() == 1


def plain_removal(rows, length):
    count = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, t in data:
        for p in range(len(t) - length + 1):
            count[t[p : p + length]] = count.get(t[p : p + length], 0) + 1
    out = []
    for i, t in data:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if count[t[p : p + length]] > 1:
                gone[p : p + length] = True
        gone = gone[: len(t)]
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(t) else 0
        out.append((i or 0, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def small(docs, length, gram, reach):
    """The operator with short strings, so that small texts have many cases."""
    own = suffixes.with_key(docs.select("doc_id", "text"))
    starts = suffixes.repeated_starts(own, length, gram, reach)
    types = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    found = suffixes._with_runs(own, starts, suffixes._digest_batches(length), types)
    return sorted((r.doc_id or 0, *r[1:]) for r in found.collect())


@pytest.mark.parametrize(("length", "gram", "reach", "seed"), [(40, 6, 17, 1), (25, 4, 8, 2), (64, 8, 57, 3)])
def test_removal_of_repeated_bytes(spark, documents, length, gram, reach, seed):
    rng = random.Random(seed)
    text = lambda n, letters="abcdefgh é": "".join(rng.choice(letters) for _ in range(n))
    common = [text(length + k) for k in (-8, -1, 0, 1, 30, 200)]
    rows = []
    for i in range(60):
        parts = [text(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):
            c = rng.choice(common)
            cut = rng.randint(0, len(c) // 3) if rng.random() < 0.4 else 0
            parts += [c[cut:], text(rng.randint(0, 50))]
        rows.append((i, "".join(parts)))
    rows += [(100, "x" * 500), (101, "ab" * 90), (102, rows[3][1]), (103, rows[3][1] * 2), (104, None), (105, ""), (106, "x" * length), (107, "abc" * 100)]
    assert small(documents(rows).repartition(5), length, gram, reach) == plain_removal(rows, length)


def test_runs_that_cross_buckets(spark, documents, monkeypatch):
    monkeypatch.setattr(suffixes, "BUCKET_ROWS", 3)
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    core = text(60)
    rows = [(i, text(30) + core + text(30)) for i in range(25)] + [(50, core), (51, text(400))]
    assert small(documents(rows), 40, 6, 17) == plain_removal(rows, 40)


def test_removal_on_odd_texts(spark, documents, odd_texts):
    got = sorted((r.doc_id or 0, *r[1:]) for r in suffixes.removal_digests(documents(odd_texts)).collect())
    assert got == plain_removal(odd_texts, 400)
    assert suffixes.removal_digests(documents([])).collect() == []
    kept = suffixes.without_repeats(documents(odd_texts))
    assert {(r.doc_id, r.text) for r in kept.collect()} >= {(2, None), (3, ""), (9, ""), (8, odd_texts[8][1])} and kept.columns == documents([]).columns
    assert all(r.n_chars == len(r.text or "") or r.text is None for r in kept.collect())


def test_cut_inside_a_character(spark, documents):
    shared = "é" * 10 + "0123456789" * 60
    rows = [(1, "a" + shared), (2, "ć".join(["b", shared])), (3, "É" + shared[1:])]
    for r in suffixes.without_repeats(documents(rows)).collect():
        r.text.encode()


def test_passages_of_fifty_words(spark, documents, odd_texts):
    rng = random.Random(6)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))
    passage, long, own = words(51), words(90), [words(60) for _ in range(6)]
    assert 240 < len(passage) < 400 < len(long)
    rows = [(21, f"{own[0]} {passage} {own[1]}"), (22, f"{passage} {own[2]}"), (23, own[3]), (24, f"{long} {own[4]} {passage}"), (25, f"{own[5]} é{long}"), (26, "é" + own[3][:230])]
    got = suffixes.passage_digests(documents(rows + odd_texts).repartition(3)).collect()
    assert sorted((r.doc_id or 0, *r[1:5]) for r in got) == plain_removal(rows + odd_texts, 400)
    assert sorted((r.doc_id or 0, r.n_passage_bytes) for r in got) == [(r[0], r[2]) for r in plain_removal(rows + odd_texts, 240)]
    text = {r.doc_id: r.text for r in got}
    assert passage not in text[21] + text[22] + text[24] and own[0] in text[21] and own[4] in text[24] and text[23] == own[3] and text[26] == rows[5][1]
    plain = suffixes.without_repeats(documents(rows + odd_texts), *suffixes.PASSAGE).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in plain) == sorted((r.doc_id or 0, r.text or "") for r in got) and text[2] is None
    assert suffixes.passage_digests(documents([])).collect() == []


def test_contexts_that_cross_buckets(spark, documents, monkeypatch):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    core, sides = text(37), [(text(9), text(9)) for _ in range(4)]
    rows = [(i, text(30) + a[i % 7 :] + core + b[: 2 + i % 5] + text(30)) for i, (a, b) in enumerate(rng.choices(sides, k=40))]
    rows += [rows[3], rows[3], (50, rows[3][1])]
    for buckets in (3, 250_000):
        monkeypatch.setattr(suffixes, "BUCKET_ROWS", buckets)
        assert small(documents(rows).repartition(4), 40, 6, 17) == plain_removal(rows, 40)


def test_multikey_quicksort():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3000, 50_000):
        a, b, c = rng.integers(-5, 5, n), rng.integers(0, 9, n), rng.integers(0, 2**60, n)
        got, want = suffixes.multikey_order([a, b, c], small=16), np.lexsort((c, b, a))
        assert all((x[got] == x[want]).all() for x in (a, b, c))


def sized(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, size long, sources array<string>, place string, times int")


def test_targets_share_and_stop():
    assert mixing.targets({"a": 100, "b": 100, "c": 100}, {"a": 5, "b": 2, "c": 1}) == {"a": 187.5, "b": 75.0, "c": 37.5}
    got = mixing.targets({"a": 10, "b": 100, "c": 190}, {"a": 5, "b": 2, "c": 1})
    assert got["a"] == 30 and got["b"] == pytest.approx(180) and got["c"] == pytest.approx(90)
    assert mixing.targets({"a": 0, "b": 0}, {"a": 5, "b": 2}) == {"a": 0, "b": 0} and mixing.targets({}, {}) == {}
    assert mixing.targets({"a": 10}, {"a": 1}, total=100) == {"a": 30}


def test_flow_uses_overlaps_before_repeats():
    # b can only be met from what it shares with a; then a takes its own words, and nothing is used twice.
    got = mixing.flow({("a",): 100, ("a", "b"): 100}, {"a": 100.0, "b": 100.0})
    assert got == {("a",): pytest.approx(100), ("a", "b"): pytest.approx(100)}
    got = mixing.flow({("a",): 100, ("b",): 50}, {"a": 50.0, "b": 120.0})
    assert got == {("a",): pytest.approx(50), ("b",): pytest.approx(120)}
    got = mixing.flow({("a",): 10, ("a", "b"): 10}, {"a": 60.0, "b": 30.0})
    assert sum(got.values()) == pytest.approx(60) and all(v <= 30 + 1e-6 for v in got.values())


def plain_flow_cost(patterns, quotas, most, step):
    """Least cost of a small flow by trying all amounts, in units of ``step``."""
    from itertools import product

    keys = [(p, s) for p in patterns for s in p]
    best = None
    for amounts in product(*(range(0, most * patterns[p] // step + 1) for p, _ in keys)):
        used = {p: sum(a for (q, _), a in zip(keys, amounts) if q == p) * step for p in patterns}
        given = {s: sum(a for (_, t), a in zip(keys, amounts) if t == s) * step for s in quotas}
        if any(used[p] > most * patterns[p] for p in patterns) or any(given[s] > quotas[s] for s in quotas):
            continue
        cost = sum((n + 1) * min(patterns[p], max(0, used[p] - n * patterns[p])) for p in patterns for n in range(most))
        key = (-sum(given.values()), cost)
        best = key if best is None or key < best else best
    return best


def test_flow_has_least_cost():
    patterns, quotas = {("a",): 20, ("a", "b"): 20, ("b", "c"): 10}, {"a": 50.0, "b": 30.0, "c": 20.0}
    got = mixing.flow(patterns, quotas, 2)
    cost = sum((n + 1) * min(patterns[p], max(0, got[p] - n * patterns[p])) for p in patterns for n in range(2))
    want = plain_flow_cost(patterns, quotas, 2, 10)
    assert (-sum(got.values()), cost) == (pytest.approx(want[0]), pytest.approx(want[1]))


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(1, 400), [rng.choice(["a", "b", "b", "b", "c"]) if i % 11 else None], "x", 1) for i in range(900)]
    made = mixing.plan(sized(spark, rows))
    got = made.apply(sized(spark, rows)).collect()
    targets = {s: t for s, _, t in made.quotas}
    assert list(targets) == ["a", "b", "c", None] and sum(targets.values()) == pytest.approx(sum(r[1] for r in rows))
    for s, target in targets.items():
        own = [r for r in got if r.sources == [s]]
        assert abs(sum(r.size * r.times for r in own) - target) <= max(3, 0.002 * target)
        assert all(0 <= r.times <= 3 for r in own) and sum(r.times == 0 for r in own) * sum(r.times > 1 for r in own) == 0 or target < 2 * sum(r.size for r in own)
    assert mixing.plan(sized(spark, rows).repartition(5)) == made


def test_mix_with_overlaps_and_odd_rows(spark):
    rows = [(i, 10, ["a", "b"] if i % 2 else ["a"], "x", 1) for i in range(40)]
    rows += [(100, 0, ["a"], "x", 1), (101, None, ["a"], "x", 1), (102, 10, [], "x", 1), (103, 10, None, "x", 1), (0, 10, ["a"], "x", 1), (None, 10, ["b", "b"], "x", 1)]
    made = mixing.plan(sized(spark, rows), weights={"a": 1, "b": 1})
    got = {r.doc_id: r.times for r in made.apply(sized(spark, rows)).collect()}
    assert got[100] == got[101] == got[102] == got[103] == 0 and len(got) == 45
    none = mixing.plan(sized(spark, []))
    assert none.quotas == [] and none.apply(sized(spark, rows)).filter("times > 0").count() == 0


@pytest.mark.parametrize("order", range(3))
def test_a_long_document_does_not_end_the_mix(spark, monkeypatch, order):
    monkeypatch.setattr(mixing, "SEED", order)
    rows = [(0, 100_000, ["a"], "x", 1)] + [(i, 300, ["a"], "x", 1) for i in range(1, 334)]
    made = mixing.plan(sized(spark, rows), most=1, total=99_000)
    got = made.apply(sized(spark, rows)).collect()
    assert sum(r.size * r.times for r in got) == 99_000 and all(r.times in (0, 1) for r in got)


@pytest.mark.parametrize("most", [1, 3])
def test_in_the_end_nothing_fits(spark, most):
    rng = random.Random(most)
    rows = [(i, int(rng.paretovariate(0.6) * 20), [rng.choice("abc")], "x", 1) for i in range(400)]
    rows += [(i, 7, ["a"], "x", 1) for i in (1000, 1000, 1000)]  # rows of one place, used alike
    made = mixing.plan(sized(spark, rows), most=most, total=sum(r[1] for r in rows) * 0.6)
    got = made.apply(sized(spark, rows)).collect()
    for s, _, target in made.quotas:
        own = [r for r in got if r.sources == [s]]
        left = round(target) - sum(r.size * r.times for r in own)
        assert left >= 0 and not any(r.size <= left and r.times < most for r in own if r.doc_id != 1000) and max(r.times for r in own) <= most
    assert len({r.times for r in got if r.doc_id == 1000}) == 1


def test_words(spark):
    texts = [" a  b\tc ", "", None, "é x\x0by"]
    got = [r.w for r in spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.words(mixing.F.col("t")).alias("w")).collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
