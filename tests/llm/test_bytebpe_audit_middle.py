"""Byte-level BPE, the audit of filters and fill-in-the-middle against plain versions of the same."""

import base64
import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import bytebpe, filteraudit, piecetable
from tallyframe.llm.base import text_runs
from tallyframe.llm.catalog import all_queries
from tallyframe.llm.queries import RANKS

# Fixed value: the pattern that goes with the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(texts):
    """Ids of each text, with a check that they decode to it."""
    ranks, out = bytebpe.ranks_of(RANKS), []
    for _, _, data, offsets in text_runs(pa.array(texts, pa.string())):
        ids, ends, at = bytebpe.encode_texts(data, offsets, ranks)
        assert bytebpe.decode_run(ids, ends, ranks).tobytes() == data.tobytes()
        out += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet="ab'strvemld 19\n\t é日 !._😀²", max_size=40), st.text(max_size=20)), max_size=8))
def test_ids_are_the_librarys(library, texts):
    assert ids_of(texts) == [library.encode_ordinary(t) for t in texts]


def test_ids_of_long_and_odd_texts(library):
    rnd = random.Random(3)
    texts = [
        "x" * 30_000, "'s" * 3000, " " * 3000, "ab cd " * 60_000, "", "a", "'ll've", "日本" * 9000, "".join(rnd.choice("a1!' sé\n") for _ in range(400_000)),
        "".join(chr(rnd.randrange(32, 0x2FFF)) for _ in range(20_000)), "<|endoftext|>",
    ]
    assert ids_of(texts) == [library.encode_ordinary(t) for t in texts]


def test_a_worker_that_forgets_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(bytebpe, "REMEMBERED", 50)
    ranks = bytebpe.Ranks(RANKS)
    texts = [" ".join(f"wor{i}d{i * 7}x" for i in range(k, k + 40)) for k in range(0, 400, 25)]
    for t in texts:
        ids, _, _ = bytebpe.encode_run(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]), ranks)
        assert ids.tolist() == library.encode_ordinary(t)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=900))
def test_scan_is_the_step_by_step_state(kinds):
    state, want = bytebpe.START, []
    for k in kinds:
        state = int(bytebpe.STEP[k, state])
        want.append(state)
    assert bytebpe.scan(np.array(kinds, np.uint8)).tolist() == want


def test_bytes_that_are_no_text_decode_to_themselves():
    parts = [b"ok \xff\xfe more", b"cut \xe6\x97", b"\xa5 start", "日本".encode()]
    data = np.frombuffer(b"".join(parts), np.uint8)
    offsets = np.append(0, np.cumsum([len(p) for p in parts]))
    ranks = bytebpe.ranks_of(RANKS)
    ids, ends, at = bytebpe.encode_run(data, offsets, ranks)
    assert [bytebpe.decode_run(ids[a:b], ends[a:b] - offsets[i], ranks).tobytes() for i, (a, b) in enumerate(zip(at[:-1], at[1:]))] == parts


def test_encoded_rows(spark, documents, odd_texts, library):
    docs = documents(odd_texts)
    tokens = bytebpe.encoded(docs, RANKS)
    got = Counter((r.doc_id, tuple(r.ids)) for r in tokens.collect())
    assert got == Counter((i, tuple(library.encode_ordinary(t or ""))) for i, t in odd_texts)
    back = Counter(tuple(r) for r in bytebpe.decoded(tokens, RANKS).collect())
    assert back == Counter((i, t or "") for i, t in odd_texts)
    assert bytebpe.encoded(documents([]), RANKS).collect() == []


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_registered_bytebpe(spark, folder, library):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = Counter()
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        want[(r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(r.text or ""))] += 1
    assert Counter(tuple(r) for r in all_queries()["op11_bytebpe"](spark, folder).collect()) == want


def fails(text, later):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    capitals = sum("A" <= c <= "Z" for c in text)
    yes = (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * capitals > 5 * len(text), any(c in "#$%&*|" for c in text), later)
    return {letter for letter, y in zip("ABCDE", yes) if y}


def plain_audit(rows, labels):
    """rows of (doc_id, text, source), labels of (doc_id, quality, toxic): every document goes through every order by itself."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = {}
    for source in {s or "" for *_, s in rows}:
        docs = [(i, fails(t or "", i is not None and first[t or ""] < i)) for i, t, s in rows if (s or "") == source]
        good = {i for i, q, _ in labels if q == 1 and i is not None}
        toxic = {i for i, _, x in labels if x == 1 and i is not None}
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                failing = sum(f in d[1] for d in docs)
                shapley[f] += len(gone)
                out[(source, order, step)] = [
                    len(left), len(gone), failing - len(gone), sum(d[1] == {f} for d in docs), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone),
                ]
        for (s, order, step), counts in out.items():
            if s == source:
                counts.append(shapley[order[step - 1]])
    return out


def audited(frame):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = frame.collect()
    out = {(r.part, r.filter_order, r.step): [r[c] for c in names] for r in rows}
    assert len(out) == len(rows)
    return out


def test_audit_of_odd_documents(spark, documents, odd_texts):
    long = " ".join(f"word{i}" for i in range(70))
    more = [(20, long), (21, long), (21, long), (5000, long), (22, long + " #"), (23, long.upper()), (24, "same " * 80), (None, long), (None, long), (25, "a\x0bb\x0cc\rd " * 30)]
    rows = [(i, t, s) for (i, t), s in zip([*odd_texts, *more], ["web", None, "", "books", "web"] * 9)]
    labels = [(20, 1, 0), (21, 1, 1), (21, 0, 0), (5000, 1, None), (3, None, 1), (None, 1, 1), (1, 1, 1), (24, 0, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert audited(filteraudit.audit(documents(rows), frame)) == plain_audit(rows, labels)
    assert filteraudit.audit(documents([]), frame).collect() == []
    none = frame.limit(0)
    assert audited(filteraudit.audit(documents(rows[:6]), none)) == plain_audit(rows[:6], [])


def test_registered_audit(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert audited(all_queries()["op12_filters"](spark, folder)) == plain_audit(rows, labels)


def test_audit_uses_no_python_worker_and_moves_no_text(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = filteraudit.documents_by_text(docs, labels)
    assert "text" not in rows.columns
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Arrow|Pandas|CartesianProduct", plan)
    one = filteraudit.interactions(filteraudit.cells(filteraudit.with_later_copies(rows, 4)))
    assert not re.search(r"Python|Arrow|Pandas|CartesianProduct", one._jdf.queryExecution().executedPlan().toString())


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_middle(doc_id, text, seed=42):
    units = UNIT.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if text == "" or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def filled_rows(texts, ids, seed=42):
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    return [tuple(r.values()) for out in piecetable._fill_batches(iter([batch]), seed) for r in out.to_pylist()]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0b<PSM>é日", max_size=24), min_size=1, max_size=8), st.integers(0, 10**6), st.integers(0, 99))
def test_forms_of_any_text(texts, first, seed):
    ids = range(first, first + len(texts))
    got = filled_rows(texts, ids, seed)
    want = [plain_middle(i, t, seed) for i, t in zip(ids, texts)]
    assert [r[:6] for r in got] == want
    assert [r[6] for r in got] == [sha(r[5]) for r in got]
    forms = {str(f): k for k, f in enumerate(piecetable.FORMS)}
    assert [b"".join(piecetable.split_output(r[5].encode(), forms[r[2]])).decode() for r in got] == texts


def test_all_forms_occur_with_their_shares():
    rows = filled_rows([f"one two three four {i}" for i in range(4000)], range(4000))
    share = {f: n / 4000 for f, n in Counter(r[2] for r in rows).items()}
    assert abs(share["plain"] - 0.5) < 0.03 and abs(share["spm"] - 0.4) < 0.03 and abs(share["psm"] - 0.1) < 0.02


def test_middle_of_odd_documents(spark, documents, odd_texts):
    rows = [*odd_texts, (40, "with <P> inside"), (41, "half <S"), (42, "> <M"), (43, "tail \n\n"), (44, " \n"), (45, "<S>")]
    out = piecetable.filled(documents(rows))
    assert Counter(tuple(r)[:6] for r in out.collect()) == Counter(plain_middle(i, t or "") for i, t in rows)
    back = piecetable.restored(out)
    assert Counter((r.doc_id, r.restored, r.restored_sha256) for r in back.collect()) == Counter((i, t or "", sha(t or "")) for i, t in rows)
    assert piecetable.restored(piecetable.filled(documents([]))).collect() == []


def test_an_output_without_its_sentinels_is_an_error():
    with pytest.raises(ValueError, match="lacks <S>"):
        piecetable.split_output(b"<P>abc", piecetable.PSM)
    with pytest.raises(ValueError, match="lacks <S>"):
        piecetable.split_output(b"plain", piecetable.SPM)
