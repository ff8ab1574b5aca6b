import random

from reelhouse.llm import decontam as dc


def brute(texts, items):
    out = set()
    for item_id, t in items:
        ws = dc.words(t)
        k = min(5, len(ws))
        want = dc.shingles(ws, k) if ws else set()
        for i, x in enumerate(texts):
            got = len(want & dc.shingles(dc.words(x), k))
            if want and got * 10 >= len(want) * 8:
                out.add((i, item_id, got, len(want)))
    return out


def frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "1 AS doc_id", "2 AS matched")


def test_matches_brute_force_at_every_threshold_side(spark, docs):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(rnd.randint(5, 60)))) for i in range(40)]
    items += [(40, "Short one"), (41, None), (42, "..."), (43, items[0][1]), (None, items[1][1])]
    texts = [None, "", "short ONE!", "a short one"]
    for _, t in items[:40]:
        ws = t.split()
        for _ in range(3):  # damage some words, bury the rest in a long text
            hurt = [w if rnd.random() > 0.04 else word() for w in ws]
            texts.append(" ".join([word() for _ in range(300)] + hurt + [word() for _ in range(50)]).title())
    texts.append(" ".join(word() for _ in range(50_000)) + " " + items[3][1])
    want = brute(texts, items)
    found = dc.contaminated(docs(texts), frame(spark, items))
    got = {(r.doc_id, r.item_id, r.matched, r.item_shingles) for r in found.collect()}
    assert got == want and len(want) > 40


def test_short_items_are_found_inside_long_texts(spark, docs):
    items = [(1, "the secret answer"), (2, "Answer"), (3, "one two three four"), (4, "a b c d e"), (5, "..."), (6, "the secret answer")]
    texts = [
        "well the secret answer is here", "the secret", "The Secret, answer!", "x " * 3_000 + "one two three four five", "one two four three",
        "a b c d", "a b c d e", None, "answers",
    ]
    got = {(r.doc_id, r.item_id, r.matched, r.item_shingles) for r in dc.contaminated(docs(texts), frame(spark, items)).collect()}
    assert got == brute(texts, items)
    assert {(i, j) for i, j, _, _ in got} == {(0, 1), (0, 6), (2, 1), (2, 6), (0, 2), (2, 2), (3, 3), (6, 4)}


def test_repeated_documents_and_items_give_repeated_rows(spark, docs):
    text = " ".join(f"w{j}" for j in range(12))
    found = dc.contaminated(docs([text, text, text], [1, 1, None]), frame(spark, [(7, text), (7, text), (None, text)])).collect()
    assert sorted((r.doc_id or 0, r.item_id or 0) for r in found) == sorted([(1, 7)] * 4 + [(1, 0)] * 2 + [(0, 7)] * 2 + [(0, 0)])


def test_a_full_filter_changes_nothing(spark, docs, monkeypatch):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(9)]
    texts = [t for _, t in items] + ["nothing here"]
    monkeypatch.setattr(dc, "FILTER_BITS", 64)  # every shingle passes
    got = dc.contaminated(docs(texts), frame(spark, items))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, i) for i in range(9)}


def test_empty_tables(spark, docs):
    assert dc.contaminated(docs(["a b c d e f"]), frame(spark, [])).count() == 0
    assert dc.contaminated(docs([]), frame(spark, [(1, "a b c d e f")])).count() == 0


def test_sketch_covers_the_misses_it_must_allow():
    for n in range(1, 200):
        assert dc.needed(n, 0.8) == -(-n * 8 // 10)
        assert dc.sketch_size(n, 0.8) > n - dc.needed(n, 0.8)
