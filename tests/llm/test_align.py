import hashlib
import random
from collections import Counter

import pytest

from llm.conftest import rows
from reelhouse.llm import align
from reelhouse.llm.queries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return align.Aligner(A, B)


def brute(both, text):
    """Whole text at once, ends from decoded bytes only."""
    none = (0, 0, 0, "", {})
    if not text:
        return none
    a = both.a.encode(" " + text, add_special_tokens=False).ids
    b = both.b.encode(text)
    spans = []
    for ids, of in ((a, both.a_bytes), (b, both.b_bytes)):
        at, ends = 0, {}
        for k, i in enumerate(ids):
            at += len(of[i])
            ends[at] = k
        if b"".join(of[i] for i in ids) != (" " + text).encode():
            return none
        spans.append(ends)
    groups, links, i, j = [], Counter(), 0, 0
    for e in sorted(set(spans[0]) & set(spans[1])):
        p, q = spans[0][e] + 1, spans[1][e] + 1
        groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
        links[a[p - 1], b[q - 1]] += 1
        i, j = p, q
    return len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), dict(links)


def told(both, text):
    *head, pairs, times = both.documents([text])[0]
    return (*head, {(p // align.PAIR, p % align.PAIR): n for p, n in zip(pairs.tolist(), times.tolist())})


HARD = [
    "", None, " ", "  a  b ", "a\nb\n\n c", "ﬁ é x", "𝕏漢字 𝕏", "<s> <0x41> </s><|endoftext|> x", "▁ a▁b", "don't 's re've",
    "a\u0000b", "é　b\x85\x1c", "x\r\n y\t\tz", "no.spaces,at-all!" * 40, "w" * 5000, "naïve çà–—“q”", "́combining á",
]


def test_pieces_give_the_tokens_of_the_whole_text(both):
    assert both.words_alone
    for text in HARD:
        assert told(both, text) == brute(both, text), text
    rng = random.Random(2)
    signs = [*"abZé'ß \n\t.,!?09𝕏漢▁\r-_　\x1c"] + ["'re", "</s>", "<0x41>", "don't ", " the", "Ünï", "  "]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 14))) for _ in range(4_000)]
    for text, got in zip(texts, both.documents(texts)):
        *head, pairs, times = got
        links = {(p // align.PAIR, p % align.PAIR): n for p, n in zip(pairs.tolist(), times.tolist())}
        assert (*head, links) == brute(both, text), text


def test_without_cuts_the_result_is_the_same(both):
    whole = align.Aligner(A, B)
    whole.words_alone = False
    for text in HARD:
        assert told(whole, text) == told(both, text)


def test_a_worker_that_forgets_gives_the_same(both, monkeypatch):
    want = [told(both, t) for t in HARD]
    monkeypatch.setattr(align, "CACHE_WORDS", 3)
    monkeypatch.setattr(align, "BLOCK_LETTERS", 5)
    small = align.Aligner(A, B)
    assert [told(small, t) for t in HARD] == want and [told(small, t) for t in HARD] == want


def test_a_worker_that_forgets_keeps_the_words_it_met_again(both, monkeypatch):
    monkeypatch.setattr(align, "CACHE_WORDS", 40)
    small, learnt = align.Aligner(A, B), Counter()
    learn = small.learn
    monkeypatch.setattr(small, "learn", lambda words: (learnt.update(words), learn(words)))
    for k in range(12):
        text = "the cat. naïve ﬁ " + " ".join(f"w{k}x{i}" for i in range(20))
        assert told(small, text) == brute(both, text) and len(small.known) <= 60
    assert [learnt[w] for w in ("the", "cat.", "naïve", "ﬁ", "w0x0")] == [1] * 5
    told(small, "w0x0")
    assert learnt["w0x0"] == 2
    # No more than half of either limit is kept.
    again = [f"v{i}" for i in range(60)]
    for text in (" ".join(again), " ".join(again), "one", "more"):
        assert told(small, text) == brute(both, text) and len(small.known) <= 100
    assert len(small.known) <= 21 and len(small.groups) == len(small.known) == len(small.again) == len(small.told) // 4
    monkeypatch.setattr(align, "CACHE_LETTERS", 30)
    for text in ("the cat. ﬁ", "the cat. ﬁ", "w" * 50, "the cat. ﬁ"):
        assert told(small, text) == brute(both, text)
    assert small.letters == sum(map(len, small.known))


@pytest.mark.parametrize("limit", [align.BROADCAST_PAIRS, 0])
def test_documents(both, docs, limit):
    texts = [*HARD, "the cat. the cat", "the cat. the cat", "The dog, the cat"]
    ids = [None if t == " " else i // 2 for i, t in enumerate(texts)]
    want = [brute(both, t) for t in texts]
    total = Counter()
    for w in want:
        total.update(w[4])
    most = Counter()
    for (_, b), n in total.items():
        most[b] = max(most[b], n)
    expect = [
        (i, *w[:3], w[2], sum(n for p, n in w[4].items() if total[p] == most[p[1]]), sum(total[p] * n for p, n in w[4].items()), w[3])
        for i, w in zip(ids, want)
    ]
    got = [tuple(r) for r in align.align_documents(docs(texts, ids), A, B, broadcast_pairs=limit).collect()]
    assert sorted(got, key=str) == sorted(expect, key=str)


def test_empty_table(docs):
    assert rows(align.align_documents(docs([]), A, B)) == {}
    got = rows(align.align_documents(docs([None, ""]), A, B))
    assert [(r.n_a, r.n_links, r.count_sum, r.groups_sha256) for r in got.values()] == [(0, 0, 0, "")] * 2
