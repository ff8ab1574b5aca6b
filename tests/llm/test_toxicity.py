import random
import zlib

import numpy as np
import pytest

from llm.conftest import rows
from reelhouse.llm import toxicity as tox

BAD = ["idiot", "trash", "moron", "loser", "scum"]


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    texts, labels = [], []
    for _ in range(n):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(5, 60))]
        bad = rnd.random() < 0.2
        if bad:
            for _ in range(rnd.randint(2, 6)):
                words.insert(rnd.randrange(len(words)), rnd.choice(BAD).title())
        texts.append(" ".join(words))
        labels.append(int(bad))
    return texts, labels


def label_frame(spark, pairs):
    return spark.createDataFrame([(i, None, y, "x") for i, y in pairs], "doc_id long, quality int, toxic int, text string")


def flat(vectors):
    terms = np.array([t for v in vectors for t in sorted(v)], dtype=np.int64)
    weights = np.array([v[t] for v in vectors for t in sorted(v)])
    return terms, weights, np.array([len(v) for v in vectors])


def ask(index, q, k, skip=None):
    terms = np.array(sorted(q), dtype=np.int64)
    at, cosines = index.search([(terms, np.array([q[t] for t in sorted(q)]))], k, None if skip is None else [skip])[0]
    return [int(index.ids[p]) for p in at], cosines.tolist()


@pytest.mark.parametrize("block, common", [(16, 10), (64, 64), (7, 0), (64, 10_000)])
def test_index_equals_full_scan(block, common):
    rnd = random.Random(4)
    vectors = []
    for _ in range(500):
        raw = {min(int(rnd.expovariate(0.08)), 199): rnd.random() for _ in range(rnd.randint(1, 12))}
        if vectors and rnd.random() < 0.3:
            raw = dict(rnd.choice(vectors))  # ties
        norm = sum(v * v for v in raw.values()) ** 0.5
        vectors.append({t: v / norm for t, v in raw.items()})
    ids = rnd.sample(range(10_000), 500)
    index = tox.BlockMaxIndex(*flat(vectors), np.array(ids), 200, block=block, common=common)
    for n, q in enumerate(vectors[:120]):
        skip = None if n % 3 else ids[n]
        sims = [(round(sum(w * v.get(t, 0) for t, w in q.items()), 9), i) for v, i in zip(vectors, ids) if i != skip]
        sims = sorted((-s, i) for s, i in sims if s > 0)
        want = [x for x in sims if x[0] <= sims[min(7, len(sims)) - 1][0] + 2e-9]  # all as near as the seventh
        got, cosines = ask(index, q, 7, None if skip is None else int(np.flatnonzero(index.ids == skip)[0]))
        assert cosines == pytest.approx([-s for s, _ in want], abs=2e-9) and sorted(got) == sorted(i for _, i in want)


def test_index_skips_blocks():
    vectors = [{0: 0.6, 1 + i // 64: 0.8} for i in range(640)]  # a common term, and one of the block's own
    index = tox.BlockMaxIndex(*flat(vectors), np.arange(640), 11, common=100)
    got, cosines = ask(index, {0: 0.6, 4: 0.8}, 5)
    assert got == list(range(192, 256)) and set(cosines) == {1.0} and index.opened == 1


def test_every_text_is_searched(spark, docs):
    """A text equal to a labelled toxic example is found by its rare words alone."""
    texts, labels = corpus(300)
    rare = "unheard zyzzyva quokka wombat"
    texts += [rare, rare + " numbat", rare.title(), "nowhere else", "Wombat"]
    ids = list(range(len(texts)))
    train = next(i for i in range(10_000, 10_100) if zlib.crc32(str(i).encode()) % 5)
    ids[300] = train
    got = rows(tox.score_documents(docs(texts, ids), label_frame(spark, [*enumerate(labels), (train, 1)])))
    for i in (train, 301, 302):
        assert got[i].predicted == 1 and got[i].evidence[0].doc_id == train and got[i].evidence[0].cosine > 0.8
    assert got[304].evidence and got[304].evidence[0].doc_id == train
    assert all(r.evidence for i, r in got.items() if i < 300) and not got[303].evidence


def test_scores_do_not_depend_on_ids(spark, docs):
    texts, labels = corpus(200)
    texts, labels = texts + texts[:40], labels + labels[:40]  # ties
    free = [i for i in range(5_000) if zlib.crc32(str(i).encode()) % 5]
    scores = []
    for ids in (free[:240], free[1_000:760:-1], free[500:740]):
        got = rows(tox.score_documents(docs(texts, ids), label_frame(spark, zip(ids, labels))))
        scores.append([round(got[i].score, 9) for i in ids])
    assert scores[0] == scores[1] == scores[2]


def test_held_out_accuracy_and_calibration(spark, docs):
    texts, labels = corpus()
    got = rows(tox.score_documents(docs(texts), label_frame(spark, enumerate(labels))))
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [i for i, r in got.items() if r.held_out]
    assert len(held) > 50 and np.mean([got[i].predicted == labels[i] for i in held]) > 0.97
    toxic = [r for i, r in got.items() if labels[i]]
    assert all(e.cosine > 0 and not got[e.doc_id].held_out for r in toxic for e in r.evidence)


def test_held_out_labels_and_other_columns_change_nothing(spark, docs):
    texts, labels = corpus(200)
    train = lambda i: zlib.crc32(str(i).encode()) % 5 != 0
    a = rows(tox.score_documents(docs(texts), label_frame(spark, enumerate(labels))))
    flipped = [(i, y if train(i) else 1 - y) for i, y in enumerate(labels)]
    b = rows(tox.score_documents(docs(texts), label_frame(spark, flipped + [(None, 1), (3, None)])))
    assert {i: r.score for i, r in a.items()} == {i: r.score for i, r in b.items()}


def test_edges(spark, docs):
    texts = [None, "", "idiot " * 30_000, "x", "x"]
    no_labels = rows(tox.score_documents(docs(texts), label_frame(spark, [])))
    assert all(r.score == 0 and r.predicted == 0 for r in no_labels.values()) and len(no_labels) == 5
    one = rows(tox.score_documents(docs(texts), label_frame(spark, [(i, 1) for i in range(5)])))
    assert all(r.predicted == 1 for r in one.values())
    assert tox.score_documents(docs([]), label_frame(spark, [(1, 1)])).count() == 0
    null_id = tox.score_documents(docs(["a", "a"], [None, None]), label_frame(spark, [(1, 0)])).collect()
    assert [r.held_out for r in null_id] == [False, False]
