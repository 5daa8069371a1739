"""The pipeline stage by stage against plain versions, the queries, and the entry's guard."""

import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from tallyframe.llm import mixing, setjoin, suffixes
from tallyframe.llm.base import settle, table
from tallyframe.llm.catalog import all_queries, all_sql
from tests.conftest import plan_of
from tests.llm.test_joins import plain_components
from tools.compare import as_bag, tables_in_duckdb

ROOT = Path(entry_module.__file__).parent


def plain_cut(rows, length=corpus_pipeline.REPEAT_BYTES):
    """Texts without repeated strings, by counting every string."""
    count = Counter(t[p : p + length] for t in rows for p in range(len(t) - length + 1))
    out = []
    for t in rows:
        gone = set()
        for p in range(len(t) - length + 1):
            if count[t[p : p + length]] > 1:
                gone.update(range(p, p + length))
        out.append(bytes(b for i, b in enumerate(t) if i not in gone).decode("utf-8", "ignore"))
    return out


@pytest.fixture(scope="module")
def stages(spark, folder):
    """The table that each stage reads and makes."""
    made = [table(spark, folder, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        made.append(settle(stage(spark, made[-1], folder), "stage"))
    return made


def test_columns_stay(stages):
    assert [d.columns for d in stages[1:-1]] == [stages[0].columns] * 4


def test_toxic_go_and_clean_stay(spark, folder, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    left = {r.doc_id for r in stages[1].collect()}
    clean = [i for i, x in labels.items() if not x]
    assert sum(i in left for i in clean) >= 0.97 * len(clean)
    assert sum(r.n for r in stages[1].groupBy("doc_id").agg(mixing.F.count("*").alias("n")).collect()) == len(left)


def test_one_of_each_group_stays(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[1].collect())
    want = plain_components(rows, 5, 80)
    assert sorted(r.doc_id for r in stages[2].collect()) == [i for i, _ in rows if want[i][1] == i]


def test_repeated_strings_go(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[2].collect())
    want = plain_cut([t.encode() for _, t in rows])
    got = {r.doc_id: (r.text, r.n_chars) for r in stages[3].collect()}
    assert got == {i: (t, len(t)) for (i, _), t in zip(rows, want)}


def test_mix_is_carried_out(stages):
    before, after = stages[3].collect(), stages[4].collect()
    size = {r.doc_id: len(r.text.split()) for r in before}
    uses = Counter(r.doc_id for r in after)
    by_source = defaultdict(int)
    taken = defaultdict(int)
    for r in before:
        by_source[r.source] += size[r.doc_id]
    for r in after:
        taken[r.source] += size[r.doc_id]
    names = sorted(by_source)
    target = mixing.targets(by_source, {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)})
    assert max(uses.values()) <= 3
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] + 60 for s in names)  # eight to ten documents a source


def test_tokens_of_all_that_is_left(stages):
    assert stages[5].filter("not lossless or n_tokens != size(ids)").count() == 0 and stages[5].count() == stages[4].count()


def test_run_is_the_stages(spark, folder, stages):
    got = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages[5].collect()))
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_stages_on_odd_documents(spark, folder, documents, odd_texts):
    """Of the odd texts the one repeated under a larger id goes, and of two equal rows one; the mix decides on the rest; every mixed row has its tokens."""
    kept = sorted({i for i, _ in odd_texts if i is not None} - {6})
    for rows in (odd_texts, []):
        made = [documents(rows)]
        for _, stage in corpus_pipeline.STAGES:
            made.append(settle(stage(spark, made[-1], folder), "odd"))
            assert made[-1].columns == made[0].columns or "ids" in made[-1].columns
        if not rows:
            assert [d.count() for d in made] == [0] * 6
            continue
        for at in (2, 3):
            assert sorted(r.doc_id for r in made[at].filter("doc_id is not null").collect()) == kept
            assert made[at].filter("doc_id is null").count() == 1
        assert {r.doc_id for r in made[4].collect()} <= {*kept, None} and 0 < made[4].count() <= 3 * made[3].count()
        assert made[5].count() == made[4].count() and made[5].filter("not lossless").count() == 0


def test_a_passage_of_51_words_goes(spark, folder, documents):
    """A passage that two documents share goes from both; what stands around it, and a text of its own, stays."""
    words = "alder birch cedar daphne elm fir gorse hazel iris jasmine kelp larch maple nettle oak pine quince rose sage thyme".split()
    passage = " ".join(f"{words[i % 20]}{words[(i * 7 + 3) % 20][:2]}" for i in range(51))
    texts = [f"first part {passage} of one", f"others {passage} stand here", "a text alone " + " ".join(reversed(passage.split()))]
    assert len(passage) >= corpus_pipeline.REPEAT_BYTES
    docs = documents(list(enumerate(texts)))
    got = {r.doc_id: r.text for r in corpus_pipeline.repeats_out(spark, docs, folder).collect()}
    assert got == {0: "first partof one", 1: "othersstand here", 2: texts[2]}


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_matches_sql(spark, folder, name):
    df = all_queries()[name](spark, folder)
    cur = tables_in_duckdb(folder).execute(all_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert as_bag(df.columns, [tuple(r) for r in df.collect()]) == as_bag(names, cur.fetchall())


def test_plans_have_no_cross_join(spark, folder):
    for name in ("op1_pages", "op3_repetition", "op5_mixing", "op7_chat", "op10_toxicity"):
        plan = plan_of(all_queries()[name](spark, folder))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_names():
    ops = [n for n in all_queries() if n != "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in ops) == list(range(1, 14))
    assert set(all_queries()) <= set(entry_module.queries()) and set(all_sql()) <= set(entry_module.oracle_sql())


def test_nothing_else_imports_the_subpackage():
    code = (
        "import sys; sys.modules['tallyframe.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; assert 'group_sum' in e.queries() and not any(n.startswith('op1_') for n in e.queries())"
    )
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True).returncode == 0
    for path in [*ROOT.glob("tallyframe/**/*.py"), *ROOT.glob("tests/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.parts:
            assert "tallyframe.llm" not in path.read_text()


def python_steps_of_a_task(plan):
    """The most Python steps between two exchanges on any way down a plan's tree."""
    most, above = 0, []
    for line in plan.split("\n\n")[0].splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        above = [x for x in above if x[0] < depth]
        steps = 0 if "Exchange" in line else (above[-1][1] if above else 0) + ("InArrow" in line or "InPandas" in line)
        above.append((depth, steps))
        most = max(most, steps)
    return most


def test_a_task_has_one_python_worker(spark, folder, monkeypatch):
    """However small the tables are that decide which texts meet. An executor keeps all workers that it ever had at once."""
    plans = {}

    def recorded(df, name, narrow=False):
        plans[name] = plan_of(df)
        return settle(df, name, narrow)

    for module in (setjoin, suffixes):
        monkeypatch.setattr(module, "settle", recorded)
    docs = table(spark, folder, "documents")
    plans["links"] = plan_of(setjoin.linked_classes(docs, setjoin.signed(docs, 5, 80), 5, 80)[1])
    plans["repeats_out"] = plan_of(corpus_pipeline.repeats_out(spark, docs, folder))
    assert {"starts", "links", "repeats_out"} <= set(plans)
    assert {name: python_steps_of_a_task(x) for name, x in plans.items() if python_steps_of_a_task(x) > 1} == {}
