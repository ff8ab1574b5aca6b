import hashlib
import re

import pytest

from llm.conftest import rows
from reelhouse.llm import exact_dedup as ed


def brute(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, len(t or "")))
    out = {}
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0]))[0]
        for i, _ in members:
            out[i] = (keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest())
    return out


TEXTS = ["a b", "ab", "a  b", "\ta\nb\r", None, "", " ", "é x", "é x", "long " * 30_000, "long" * 30_000, "ab", "A b"]


def test_groups_match_brute_force(docs):
    got = {i: (r.keep_id, r.group_size, r.kept, r.text_sha256) for i, r in rows(ed.exact_groups(docs(TEXTS))).items()}
    assert got == brute(enumerate(TEXTS))


def test_deduplicate_keeps_whole_rows_once(docs):
    frame = docs(["x y", "x y", "xy", None, ""], [5, 5, 9, None, 2])
    kept = ed.deduplicate(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, ""), (5, "x y")]


def test_null_id_comes_last(docs):
    got = ed.exact_groups(docs(["q", "q"], [None, 3])).collect()
    assert sorted((r.doc_id or -1, r.keep_id, r.kept) for r in got) == [(-1, 3, False), (3, 3, True)]


def test_empty_table(docs):
    assert ed.exact_groups(docs([])).count() == 0 and ed.deduplicate(docs([])).count() == 0


def test_directory_splits_until_buckets_fit():
    counts = {s: 10 for s in range(16)} | {3: 1_000}
    got = ed.grow_directory(counts, capacity=40, max_depth=4)
    assert [f for f, _, _ in got] == sorted(f for f, _, _ in got)
    assert sum(w for _, w, _ in got) == 16
    for first, width, depth in got:
        total = sum(counts[s] for s in range(first, first + width))
        assert width == 1 << (4 - depth) and (total <= 40 or width == 1)
    assert ed.grow_directory({}, 40, 4) == [(0, 16, 0)]


def test_small_buckets_give_the_same_groups(docs):
    texts = [f"text {i % 40}" for i in range(200)]
    index = ed.build_index(docs(texts), capacity=3)
    assert index.directory.agg({"depth": "max"}).first()[0] > 2
    got = {i: r.keep_id for i, r in rows(ed.lookup(index, docs(texts))).items()}
    assert got == {i: v[0] for i, v in brute(enumerate(texts)).items()}


def test_hot_group_is_combined_before_the_shuffle(docs):
    plan = ed.classes(docs(["same"] * 300))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Python" not in plan


def test_lookup_goes_through_bucket_and_chain(docs):
    texts = [f"text {i % 40}" for i in range(200)]
    index = ed.build_index(docs(texts), capacity=3)
    plan = ed.lookup(index, docs(texts))._jdf.queryExecution().optimizedPlan().toString()
    join = next(x for x in plan.splitlines() if "Join Inner" in x and "bucket" in x)
    assert "_h" in join and "slot" in plan and "chain" in plan and "Python" not in plan
    # a text that the index does not hold has no row
    assert rows(ed.lookup(index, docs(["text 1", "unknown"]))).keys() == {0}


def test_colliding_hashes_are_chained(docs, spark, monkeypatch):
    """All hashes alike: one bucket, one chain, told apart by digest."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(ed.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    got = {i: (r.keep_id, r.group_size, r.kept, r.text_sha256) for i, r in rows(ed.exact_groups(docs(TEXTS))).items()}
    assert got == brute(enumerate(TEXTS))
    index = ed.build_index(docs(TEXTS))
    assert index.entries.agg({"chain": "max"}).first()[0] == len({v[0] for v in got.values()})


def test_bytes_that_differ_under_one_digest_fail(docs, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(ed.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    monkeypatch.setattr(ed.F, "sha2", lambda c, n: F.lit("digest"))
    with pytest.raises(ValueError, match="differ"):
        ed.exact_groups(docs(["a", "b"]))


def test_texts_without_a_copy_do_not_move(docs):
    plan = ed.classes(docs(["same"] * 300))._jdf.queryExecution().executedPlan().toString()
    shuffled = [x for x in plan.splitlines() if "partial_max" in x]
    assert shuffled and all("_norm" not in x.split("output=")[-1] for x in shuffled)
