"""The pipeline against a brute-force version of each stage on its own input."""

import re

import corpus_pipeline as cp
import pytest
from conftest import SF_CHECK, SF_SMALL
from llm import test_decontam, test_packing, test_simhash
from reelhouse.llm import store


@pytest.fixture(scope="module")
def stages(spark):
    docs = store.table(spark, SF_SMALL, "documents")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(store.write_shared(stage(spark, out[-1], SF_SMALL), f"t-{name}"))
    return out


def texts(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


def test_columns_stay(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:5])


def test_toxic_documents_go_and_clean_ones_stay(spark):
    # The smallest table has about ten toxic labels; this one has enough to learn from.
    docs = store.table(spark, SF_CHECK, "documents")
    before, after = texts(docs), texts(cp.remove_toxic(spark, docs, SF_CHECK))
    bad = {"idiot", "trash", "moron", "loser", "scum", "pathetic", "worthless", "disgusting", "stupid", "clown"}
    n = {i: sum(w in bad for w in re.findall(r"\w+", t.lower())) for i, t in before.items()}
    toxic = {i for i in before if n[i] >= 3}
    assert len(toxic & set(after)) <= 0.05 * len(toxic)
    labels = dict(store.table(spark, SF_CHECK, "labels").select("doc_id", "toxic").collect())
    clean = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in clean) / len(clean) > 0.98


def test_exact_copies(stages):
    before, after = texts(stages[1]), texts(stages[2])
    groups = {}
    for i, t in before.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append(i)
    assert set(after) == {min(g, key=lambda i: (-len(before[i]), i)) for g in groups.values()}


def test_near_copies(stages):
    before, after = texts(stages[2]), texts(stages[3])
    roots = test_simhash.brute_components(list(before), [test_simhash.brute_fp(t) for t in before.values()], 3)
    assert set(after) == set(roots.values())


def test_benchmark_passages(spark, stages):
    before, after = texts(stages[3]), texts(stages[4])
    items = [tuple(r) for r in store.table(spark, SF_SMALL, "benchmark").select("item_id", "text").collect()]
    ids = list(before)
    hit = {ids[x[0]] for x in test_decontam.brute([before[i] for i in ids], items)}
    assert set(after) == set(ids) - hit


def test_packing_takes_all_that_is_left(spark, stages):
    got = stages[5].collect()
    assert {r.doc_id for r in got} == set(texts(stages[4]))
    assert len({r.sequence_id for r in got}) == len(test_packing.naive_best_fit([r.length for r in got], 4096))


def test_run_and_edges(spark, docs):
    odd = docs([None, "", "a", "a", "x y z"], [1, 2, 3, 3, None])
    for _, stage in cp.STAGES[:4]:
        odd = stage(spark, odd, SF_SMALL)
    assert sorted((r.doc_id or -1) for r in odd.collect()) in ([-1, 1, 3], [-1, 1])
    assert cp.pack(spark, docs([]), SF_SMALL).count() == 0


def test_long_lists_join_by_a_shuffle(spark, docs, monkeypatch):
    frame = docs(["a", "b", "c"], [1, None, 2])
    ids = spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")
    assert sorted(r.text for r in cp._without(frame, ids).collect()) == ["b", "c"]
    monkeypatch.setattr(cp, "BROADCAST_BYTES", -1)
    assert sorted(r.text for r in cp._without(frame, ids).collect()) == ["b", "c"]


def test_rows_are_judged_each_by_itself(spark, docs):
    item = store.table(spark, SF_SMALL, "benchmark").first().text
    mixed = docs([item, "clean words of one row", item, "other clean words here"], [7, 7, None, None])
    left = cp.remove_benchmark(spark, mixed, SF_SMALL)
    assert left.columns == mixed.columns
    assert sorted(r.text for r in left.collect()) == ["clean words of one row", "other clean words here"]
    long = " ".join(f"word{i}" for i in range(300))
    copies = docs([long, long, long + " ", "something else entirely"], [1, 1, None, 1])
    assert sorted(len(r.text) for r in cp.remove_near_copies(spark, copies, SF_SMALL).collect()) == [23, len(long)]
    bad = "idiot trash moron loser scum pathetic worthless disgusting stupid clown " * 3
    toxic = docs([bad, "fine words", bad, "more fine words"], [5, 5, None, None]).select("doc_id", "text")
    all_docs = store.table(spark, SF_CHECK, "documents").where("doc_id <> 5").select("doc_id", "text")
    left = cp.remove_toxic(spark, all_docs.unionByName(toxic), SF_CHECK)
    odd = left.where("doc_id is null or doc_id = 5")
    assert sorted(r.text for r in odd.collect()) == ["fine words", "more fine words"]


def test_driver_rows_start_no_python_worker(spark):
    import pyarrow as pa

    from reelhouse.llm import store

    df = store.local_frame(spark, [(1, [2, 3])], a=pa.int64(), b=pa.list_(pa.int64()))
    assert df.dtypes == [("a", "bigint"), ("b", "array<bigint>")] and [tuple(r) for r in df.collect()] == [(1, [2, 3])]
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()  # before: rows pickled by Python tasks
    assert store.local_frame(spark, [], a=pa.int32()).collect() == []
