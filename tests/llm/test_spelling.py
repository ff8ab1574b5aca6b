import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm.conftest import rows
from reelhouse.llm import spelling


def brute_counts(docs):
    found = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def brute_groups(words):
    near, holes = defaultdict(set), defaultdict(list)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].append(w)
            if (less := w[:i] + w[i + 1 :]) in words:
                near[w].add(less)
                near[less].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= set(group) - {w}
    out = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 5 * n else None
        out[w] = (form, n, len(near[w]), words[form] if form else None)

    def root(w):
        while out[w][0]:
            w = out[w][0]
        return w

    return {w: (f, root(w), n, k, m) for w, (f, n, k, m) in out.items()}


def got(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


WORDS = {
    "colour": 100, "color": 9, "colours": 19, "coulour": 20, "xolour": 4, "golour": 100, "anagram": 5, "nagaram": 5,
    "bnagram": 5, "naïvement": 50, "naivement": 6, "naïvemènt": 1, "chains": 1, "chainsy": 5, "chainsyz": 25, "chainsyzz": 125,
    "z" * 300: 7, "z" * 299: 70, "z" * 298 + "y": 7, "a" * 5000 + "b": 9, "a" * 5000 + "c": 90,
}


@pytest.mark.parametrize("leaf, share", [(2_000, 50_000), (1, 2), (3, 1)])
def test_words_match_brute_force_at_any_leaf_size(spark, leaf, share):
    table = spark.createDataFrame(list(WORDS.items()), "word string, n long")
    assert got(spelling.group_words(table, leaf, share)) == brute_groups(WORDS)


def test_one_class_of_many_words_is_split_by_halves(spark):
    rng = np.random.default_rng(3)
    words = {"".join(rng.permutation(list("aabbccdd"))): int(n) for n in rng.integers(5, 900, 400)}
    words |= {w[:3] + "e" + w[3:]: 5 for w in list(words)[:100]} | {w[:5] + "k" + w[6:]: 6 for w in list(words)[:100]}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(spelling.group_words(table, 4, 50)) == brute_groups(words)


def test_documents(docs):
    texts = [f"Recieve receive Ünder {'receive ' * 40}x{'ab' * 3000}", None, "", "1 2 3 ×÷", "receive receves"] * 6
    ids = [None if i % 7 == 6 else i // 2 for i in range(len(texts))]
    words = brute_counts(zip(ids, texts))
    assert len(words) >= 4
    assert got(spelling.spelling_variants(docs(texts, ids))) == brute_groups(words)


def test_deleted_letter(docs):
    ids = [i for i in range(5_000) if zlib.crc32(f"{i}:wörtlich".encode()) % 199 == 0][:6]
    at = zlib.crc32(f"{ids[0]}:wörtlich".encode()) % 8
    found = spelling.document_words(ids[0], "WöRTLICH wörtlich".encode())
    assert found == {("wörtlich"[:at] + "wörtlich"[at + 1 :]).encode(): 2}
    want = brute_counts((i, "WöRTLICH") for i in [*ids, *ids, *ids, *ids, *ids])
    table = docs(["WöRTLICH"] * 30, ids * 5)
    assert {r.word: r.n for r in spelling.count_words(table).collect()} == want and want


def test_empty_table(docs):
    assert rows(spelling.spelling_variants(docs([])), "word") == {}
    assert rows(spelling.spelling_variants(docs([None, "", "few words"])), "word") == {}


def test_steps_spend_the_surplus_first():
    moves, after = spelling.steps(4, 0)
    assert len(moves) == 1 + 4 + 6 and sorted(after) == [0] + [1] * 4 + [2] * 6
    assert len(spelling.steps(4, 1)[0]) == 5 and len(spelling.steps(4, 2)[0]) == 1
