"""The registered queries on the smallest tables: SQL where there is some, brute force elsewhere."""

import duckdb
import pytest

from conftest import SF_SMALL
from llm import test_align, test_packing, test_pii, test_secrets, test_simhash, test_spelling
from reelhouse.llm import queries

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF_SMALL)
    want = duck.execute(queries.ORACLE[name])
    cols = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(cols)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=key) == sorted(want.fetchall(), key=key)


def documents(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def test_op1(spark, duck):
    got = queries.op1_packing(spark, SF_SMALL).collect()
    docs = documents(duck)
    tok = test_packing.Tokenizer.from_file(test_packing.PATH)
    sizes = {}
    for r in got:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sizes == {i: len(test_packing.ids(tok, t)) // 4 + 1 for i, t in docs.items()}
    best = test_packing.naive_best_fit([r.length for r in got], 4096)
    assert len({r.sequence_id for r in got}) == len(best)


def test_op3(spark, duck):
    docs = documents(duck)
    got = {r.doc_id: r for r in queries.op3_simhash(spark, SF_SMALL).collect()}
    fps = [test_simhash.brute_fp(t) for t in docs.values()]
    assert [int(got[i].fingerprint, 16) for i in docs] == fps
    assert {i: r.component_id for i, r in got.items()} == test_simhash.brute_components(list(docs), fps, 3)


@pytest.mark.parametrize("name, base, kinds", [
    ("op5_pii", lambda t: [(p, q, k) for p, _, q, k in test_pii.base(t)], ("email", "ip", "card", "phone")),
    ("op10_secrets", lambda t: [(p, q, ("assign", "access", "hex")[k]) for p, k, q in test_secrets.base(t)], ("assign", "access", "hex")),
])
def test_spans(spark, duck, name, base, kinds):
    import hashlib

    got = {r.doc_id: r for r in queries.QUERIES[name](spark, SF_SMALL).collect()}
    for i, t in documents(duck).items():
        want = base(t or "")
        text = ",".join(f"{k}:{p}:{q}" for p, q, k in want)
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in kinds] == [sum(w[2] == k for w in want) for k in kinds]
        assert set(text.split(",")) <= set(got[i].spans.split(","))


def test_op6_on_held_out_rows(spark, duck):
    got = {r.doc_id: r for r in queries.op6_toxicity(spark, SF_SMALL).collect()}
    assert set(got) == set(documents(duck))
    labels = dict(duck.execute("SELECT doc_id, toxic FROM labels").fetchall())
    held = [i for i in labels if got[i].held_out]
    assert sum(got[i].predicted == labels[i] for i in held) / len(held) > 0.8


def test_op6_equals_a_full_scan(spark, duck):
    """Neighbours and scores of the query against cosines with every example."""
    import math
    from collections import Counter

    import numpy as np
    from reelhouse.llm import store, toxicity as tox

    docs, labels = (store.table(spark, SF_SMALL, t) for t in ("documents", "labels"))
    train = store.write_shared(tox._labelled(labels), "t")
    sample = tox._sample(docs, train, tox.EXAMPLES)
    terms = tox._terms(sample)
    texts = {i: terms.of(t) for i, t in documents(duck).items()}
    df = Counter(t for c in texts.values() for t in c)
    idf = {t: math.log((len(texts) + 1) / (df[t] + 1)) + 1 for t in range(terms.size)}

    def vector(counts):
        raw = {t: math.sqrt(n) * idf[t] * terms.factor[t] for t, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {t: x / norm for t, x in raw.items()}

    examples = {r.id: (r.y, vector(texts[r.id])) for r in sample.collect() if texts[r.id]}
    got = {r.doc_id: r for r in tox.score_documents(docs, labels).collect()}
    votes = {}
    for i, counts in texts.items():
        q = vector(counts) if counts else {}
        q.pop(terms.size - 1, None)
        sims = sorted(((-round(sum(x * v.get(t, 0.0) for t, x in q.items()), 9), j) for j, (_, v) in examples.items()))
        sims = [x for x in sims if x[0] < 0]
        near = [x for x in sims if x[0] <= sims[min(15, len(sims)) - 1][0] + 2e-9]
        assert [e.cosine for e in got[i].evidence] == [pytest.approx(-s, abs=3e-9) for s, _ in near[:15]]
        if near:
            y = np.array([examples[j][0] for _, j in near])
            totals = dict(train.groupBy("y").count().collect()) if not votes else totals  # noqa: F821
            share = [totals[c] / sum(e[0] == c for e in examples.values()) for c in (0, 1)]
            w = np.array([s * s for s, _ in near]) * np.array(share)[y]
            votes[i] = float((w * y).sum() / w.sum())
    # The score rises with the vote, and equal votes have equal scores.
    order = sorted(votes, key=votes.get)
    assert all(got[a].score <= got[b].score + 1e-6 for a, b in zip(order, order[1:]))
    assert len([i for i, c in texts.items() if c and not got[i].evidence]) < 0.05 * len(texts)


def test_op9_has_the_article_text(spark, duck):
    import html
    import re

    got = {r.page_id: r for r in queries.op9_html(spark, SF_SMALL).collect()}
    for i, page in duck.execute("SELECT page_id, html FROM pages").fetchall():
        body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        body = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", body))
        assert got[i].text == " ".join(html.unescape(body).split()) and got[i].n_chars == len(got[i].text)


def test_op11(spark, duck):
    words = test_spelling.brute_counts(documents(duck).items())
    assert test_spelling.got(queries.op11_spelling(spark, SF_SMALL)) == test_spelling.brute_groups(words)


def test_op13(spark, duck):
    from reelhouse.llm import align

    both = align.Aligner(test_align.A, test_align.B)
    docs = documents(duck)
    want = {i: test_align.brute(both, t) for i, t in docs.items()}
    total, most = {}, {}
    for w in want.values():
        for p, n in w[4].items():
            total[p] = total.get(p, 0) + n
    for (_, b), n in total.items():
        most[b] = max(most.get(b, 0), n)
    for r in queries.op13_align(spark, SF_SMALL).collect():
        a, b, g, h, links = want.pop(r.doc_id)
        best = sum(n for p, n in links.items() if total[p] == most[p[1]])
        sums = sum(n * total[p] for p, n in links.items())
        assert tuple(r) == (r.doc_id, a, b, g, g, best, sums, h)
    assert not want
