import random
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from reelhouse.llm import packing as pk
from reelhouse.llm.queries import tokenizer_path

PATH = tokenizer_path()
ODD = [
    None, "", "  ", "İstanbul ΣΑΣ it's 'RE x²³ ½ a\xa0b a\tb a\r\nc", "<|startoftext|> x<|endoftext|>y <|end", "<|STARTOFTEXT|> b",
    "é café ́x", "日本語 テスト １２３ ﬁ", "a\xa0b\u0085c\x1cd\x0be", "x'll'VE don't '' ' s", "K ſ ẞ ǅ", "!!!%%% &amp; 12,5",
]


def ids(tok, text):
    return np.array(tok.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_ids_equal_the_tokenizers():
    rnd = random.Random(3)
    signs = "ab'sSt \n\t1²é<|>İΣ́\xa0\u0085‍日!,"
    texts = ODD + ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 30))) for _ in range(1_500)]
    tok = Tokenizer.from_file(PATH)
    got = pk.WordTokenizer(PATH, limit=50).encode_batch(pa.array(texts))
    assert got == [ids(tok, t) for t in texts]
    assert pk.WordTokenizer(PATH).encode_batch(pa.array([], pa.string())) == []


def naive_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, left in enumerate(bins) if left >= n]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


def test_plan_equals_best_fit_decreasing_one_by_one():
    for seed in range(150):
        rnd = random.Random(seed)
        cap = rnd.choice([7, 16, 50, 100])
        lengths = [rnd.choice([rnd.randint(1, cap), cap, cap // 2 + 1, cap // 3 + 1]) for _ in range(rnd.randint(0, 150))]
        counts = {n: lengths.count(n) for n in lengths}
        bins, seen = {}, {}
        for n, first, k, b, per, off in pk.plan(counts, cap):
            assert seen.get(n, 0) == first
            seen[n] = first + k
            for i in range(k):
                bins.setdefault(b + i // per, []).append((off + i % per * n, n))
        assert seen == counts
        for parts in bins.values():
            at = 0
            for off, n in sorted(parts):
                assert off == at
                at += n
        assert sorted(cap - sum(n for _, n in p) for p in bins.values()) == naive_best_fit(lengths, cap)


def test_plan_is_small_whatever_the_counts():
    assert len(pk.plan({n: 10**12 + n for n in range(1, 4097)}, 4096)) < 20_000


def test_segment_tree_finds_the_tightest():
    tree = pk.SegmentTree(20)
    for at in (3, 9, 20):
        tree.add(at, 1)
    assert [tree.tightest(n) for n in (1, 3, 4, 9, 10, 20)] == [3, 3, 9, 9, 20, 20]
    tree.add(20, -1)
    assert tree.tightest(10) is None


def test_pieces_and_places(docs):
    texts = ODD + ["word " * 9_000, "one two three", "one two three"]
    packed = pk.pack_documents(docs(texts), PATH, capacity=64, with_ids=True)
    got = packed.collect()
    tok = Tokenizer.from_file(PATH)
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, t in enumerate(texts):
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        want = ids(tok, t) + np.array([1], dtype="<u4").tobytes()
        assert b"".join(np.array(r.ids, dtype="<u4").tobytes() for r in parts) == want
        assert [r.start for r in parts] == [64 * p for p in range(len(parts))]
        assert all(r.length == 64 for r in parts[:-1])
        assert all(r.ids_crc32 == zlib.crc32(want[256 * r.piece : 256 * r.piece + 4 * r.length]) for r in parts)
    for parts in by_seq.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 64
    assert len(by_seq) == len(naive_best_fit([r.length for r in got], 64))
    made = {r.sequence_id: list(r.ids) for r in pk.sequences(packed).collect()}
    assert sum(map(len, made.values())) == sum(r.length for r in got)


def test_empty_table(docs):
    assert pk.pack_documents(docs([]), PATH).count() == 0
