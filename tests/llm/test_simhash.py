import random
import re

import numpy as np
import xxhash

from llm.conftest import rows
from reelhouse.llm import simhash as sh


def brute_fp(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(ids, fps, radius):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(ids[i]), find(ids[j])
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprints_of_odd_texts(docs):
    texts = [None, "", " \x0b", "One", "one TWO", "a b c d a b c d", "É é  x", "w " * 70_000, "ǅ İ ß"]
    got = rows(sh.fingerprints(docs(texts)))
    assert [got[i].fp & (1 << 64) - 1 for i in range(len(texts))] == [brute_fp(t) for t in texts]


def near(rnd, base, bits):
    for b in rnd.sample(range(64), bits):
        base ^= 1 << b
    return base


def sample(rnd, n):
    out = [0, (1 << 64) - 1]
    while len(out) < n:
        out.append(near(rnd, rnd.choice(out), rnd.randint(0, 4)) if rnd.random() < 0.7 else rnd.getrandbits(64))
    return out


def test_links_connect_what_is_near(spark):
    for radius, blocks, chunk in ((3, 5, 4096), (3, 4, 16), (2, 4, 8), (0, 2, 4096)):
        rnd = random.Random(radius * 10 + blocks)
        fps = sorted(set(sample(rnd, 250)))
        frame = spark.createDataFrame([(sh._signed(f),) for f in fps], "fp long")
        links = sh.near_links(frame, radius, blocks, chunk)
        from reelhouse.llm import graph

        got = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in graph.components(links).collect()}
        want = brute_components(fps, fps, radius)
        groups = lambda m: {frozenset(x for x in fps if m.get(x, x) == r) for r in {m.get(x, x) for x in fps}}
        assert groups(got) == groups(want)


def test_copies_of_a_hot_block_stay_linear(spark):
    """50,000 fingerprints that agree in two fields: dealt again, not compared chunk by chunk."""
    rng = np.random.default_rng(4)
    n = 50_000
    open_ = np.uint64(sum(1 << b for b in range(64)) ^ sh.block_keys()[0])
    base = rng.integers(0, 1 << 63, dtype=np.uint64)
    fps = (base & ~open_) | (rng.integers(0, 1 << 63, n, dtype=np.uint64) & open_)
    pairs = rng.permutation(n)[:600].reshape(2, 300)  # and some near pairs
    for a, b in pairs.T:
        fps[b] = int(near(random.Random(int(a)), int(fps[a]), 3))
    fps = np.unique(fps)
    frame = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    plain, tasks = 10 * len(fps), sh.block_tasks(frame)
    assert tasks.where("i <> j").isEmpty()  # no block had to be split into chunks
    assert tasks.count() < plain + 4 * 4 * len(fps)
    links = {tuple(sorted((r.a, r.b))) for r in sh.near_links(frame).collect()}
    want = set()
    for part in range(4):  # brute force: pairs within 3 bits agree on one of four 16-bit fields
        key = (fps >> np.uint64(16 * part)) & np.uint64(0xFFFF)
        by = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[by], prepend=key[by][:1] + np.uint64(1)))
        for lo, hi in zip(cuts, [*cuts[1:], len(by)]):
            group = fps[by[lo:hi]]
            for s in range(0, len(group), 512):
                d = np.bitwise_count(group[s : s + 512, None] ^ group[None])
                for x, y in zip(*np.nonzero((d <= 3) & (d > 0))):
                    want.add(tuple(sorted((int(group[s + x].view(np.int64)), int(group[y].view(np.int64))))))
    assert links <= want and len(want) >= 290
    nodes = sorted({x for p in want for x in p})
    at = {x: i for i, x in enumerate(nodes)}
    components = lambda edges: brute_edges(len(nodes), [(at[a], at[b]) for a, b in edges])
    assert components(links) == components(want)


def brute_edges(n, edges):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_a_cluster_that_no_key_parts_is_still_whole(spark):
    rnd = random.Random(8)
    fps = sorted({near(rnd, 12345678901234567, rnd.randint(0, 3)) for _ in range(600)})
    frame = spark.createDataFrame([(sh._signed(f),) for f in fps], "fp long")
    for rekeys in (0, 1, 3):
        links = sh.near_links(frame, chunk=16, rekeys=rekeys)
        assert {x for r in links.collect() for x in r} == {sh._signed(f) for f in fps}


def test_within_counts_distances():
    rnd = random.Random(1)
    fps = np.array(sample(rnd, 64), dtype=np.uint64)
    planes = np.array([[sum((int(f) >> b & 1) << i for i, f in enumerate(fps))] for b in range(64)], dtype=np.uint64)
    for radius in (0, 1, 2, 3, 5, 6, 7, 10):
        pair, _, hit = sh.within(fps, np.zeros(64, dtype=np.int64), planes, np.array([sh._ALL]), radius)
        got = {(int(p), i) for p, h in zip(pair, hit) for i in range(64) if int(h) >> i & 1}
        assert got == {(i, j) for i in range(64) for j in range(64) if (int(fps[i]) ^ int(fps[j])).bit_count() <= radius}


def test_groups_of_documents(docs):
    base = " ".join(f"word{i}" for i in range(200))
    texts = [base, base.upper(), base + " tail", None, "", "quite another text", "x"] + [base] * 20
    got = rows(sh.near_groups(docs(texts, list(range(10, 10 + len(texts))))))
    fps = [brute_fp(t) for t in texts]
    want = brute_components(list(range(10, 10 + len(texts))), fps, 3)
    assert {i: r.component_id for i, r in got.items()} == want


def test_empty_and_null_ids(docs):
    assert sh.near_groups(docs([])).count() == 0
    got = sh.near_groups(docs(["a b c", "a b c", "zz"], [None, 4, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, 4), (4, 4)]
