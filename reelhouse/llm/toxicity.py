"""Toxicity: nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Terms are all words of the labelled examples. Words and word beginnings (4 to 6
letters) that go with the label count ``TELLING`` and ``TELLING_START`` times as
much, so that a cosine is led by them where a text has any and by its other
words where it has none. Term frequencies count by their square root. The model is fitted on
labelled rows with ``crc32(doc_id) mod 5 != 0``:

1. A bounded sample (``EXAMPLES`` per class, the smallest hashes of the id)
   gives the examples and their terms. A term is telling when chance does not
   explain its link with the label (likelihood ratio); all others stay terms.
2. One pass over the documents turns every whole text into counts of terms;
   document frequencies come from all of it. Words that no example has are one
   more term, which only adds to a text's length.
3. Examples lie in blocks of ``BLOCK``. Rare terms are added up over their
   postings; of common terms a query first takes each block's largest weight,
   which bounds what the block's examples can reach. Where few blocks can still
   reach the ``NEIGHBOURS`` best, only those are opened; else the common terms
   of many queries are added in one product. The result equals the full scan.
4. Neighbours vote with weight cosine squared, times the class's share of all
   labelled rows over its share of the sample; all examples as near as the last
   neighbour vote too, so nothing but the texts decides. A logistic curve
   fitted on the examples' own leave-one-out votes turns the vote into the score.

Every text with a word of any example is searched. A text without one (an empty
or null text too) gets the share of toxic rows. Evidence is the list of the
nearest examples with their cosines, of equally near ones the smaller ids. A row
that is an example itself is its own nearest neighbour, as an equal text is.
Nulls: rows of ``labels`` without id or label are ignored; a null doc_id is
scored and not held out. A label table that is empty gives score 0; one with a
single class gives that class's label. Repeated rows are scored alike; of
contradicting labels of a document, toxic counts. Very long texts are read
whole. Extra columns are not read, whatever their names. Empty documents give
an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import store

# Bound of the fitted model: labelled examples per class.
EXAMPLES = 4_000
# How much more a telling word counts, and a telling beginning, which other words may share.
TELLING = 6.0
TELLING_START = 2.0
NEIGHBOURS = 15
BLOCK = 64
# Terms of more examples than this, and than this share of them, are common: taken block by block.
COMMON = 64
COMMON_SHARE = 1 / 10
# Tasks that count the examples' terms.
TERM_TASKS = 24
# Queries searched together.
QUERIES = 64
# Postings of a term above which it is added by itself.
_LOOP = 128
_NO_TERMS = np.zeros(0, dtype=np.int32)
# A term is telling when chance would give its link with the label in fewer than
# exp(-MARGIN) of all tests together, and as many toxic examples have it.
MARGIN = 2.0
LEAST_COUNT = 3
PREFIXES = (4, 5, 6)
# Scores with their evidence that a worker remembers before it starts afresh.
KEPT_SCORES = 1_000
FOLDS = 5

_WORD = re.compile(r"[^\W\d_]+")


def text_terms(text: str | None) -> Counter:
    """Counts of the words and word beginnings of a whole text."""
    found = Counter(_WORD.findall((text or "").lower()))
    out = Counter(found)
    for w, n in found.items():
        for size in PREFIXES:
            if len(w) > size:
                out[w[:size] + "*"] += n
    return out


class Terms:
    """Numbers of the examples' words and of telling word beginnings."""

    def __init__(self, words: list[str], telling: list[str]):
        starts = [t for t in telling if t.endswith("*")]
        self.numbers = {w: i for i, w in enumerate([*words, *starts])}
        self.size = len(self.numbers) + 1  # and one term for all other words
        self.factor = np.ones(self.size)
        for t in telling:
            self.factor[self.numbers[t]] = TELLING_START if t.endswith("*") else TELLING
        self.stems = {t[: PREFIXES[0]] for t in starts}

    def of(self, text: str | None) -> dict[int, int]:
        """Counts of the terms in a whole text, by number."""
        found = Counter(_WORD.findall((text or "").lower()))
        out = {at: n for at, n in zip(map(self.numbers.get, found), found.values()) if at is not None}
        other = found.total() - sum(out.values())
        size0 = PREFIXES[0]
        for w in [w for w in found if w[:size0] in self.stems]:
            for size in PREFIXES:
                if len(w) > size and (p := self.numbers.get(w[:size] + "*")) is not None:
                    out[p] = out.get(p, 0) + found[w]
        if other:
            out[self.size - 1] = other
        return out


def fold_of(id_col) -> F.Column:
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(FOLDS))


class BlockMaxIndex:
    """Exact cosine search over sparse unit vectors.

    ``terms``, ``weights``: the vectors one behind the other; ``sizes``: their lengths.
    """

    def __init__(self, terms: np.ndarray, weights: np.ndarray, sizes: np.ndarray, ids: np.ndarray, n_terms: int, block: int = BLOCK, common: int = COMMON):
        n = len(sizes)
        first = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
        # Examples with the same leading term sit together, which keeps block maxima tight.
        lead, most = np.full(n, -1), np.zeros(n)
        np.maximum.at(most, owner, weights)
        largest = weights == most[owner]
        np.maximum.at(lead, owner[largest], terms[largest])
        place = np.lexsort((ids, lead))
        del owner, largest
        self.ids = ids[place]
        self.position = np.empty(n, dtype=np.int64)
        self.position[place] = np.arange(n)
        # Forward: the vectors in the new order.
        moved = first[place] - np.cumsum(sizes[place]) + sizes[place]
        at = np.repeat(moved.astype(np.int32), sizes[place]) + np.arange(len(terms), dtype=np.int32)
        self.sizes = sizes[place]
        self.first = np.cumsum(self.sizes) - self.sizes
        self.terms, self.weights = terms[at].astype(np.int32), weights[at]
        del at
        # Inverted: postings by term.
        by_term = np.argsort(self.terms, kind="stable")
        self.posts = np.repeat(np.arange(n), self.sizes)[by_term]
        self.post_weights = self.weights[by_term]
        self.df = np.bincount(self.terms, minlength=n_terms)
        self.post_first = np.cumsum(self.df) - self.df
        # Common terms: a column over all examples, and its block maxima.
        self.block, self.n_blocks = block, -(-n // block)
        self.column = np.full(n_terms, -1)
        often = np.flatnonzero(self.df > max(common, n * COMMON_SHARE))
        self.column[often] = np.arange(len(often))
        self.columns = np.zeros((len(often), n))
        at = self._slices(self.post_first[often], self.df[often])
        self.columns[np.repeat(np.arange(len(often)), self.df[often]), self.posts[at]] = self.post_weights[at]
        self.maxima = np.maximum.reduceat(self.columns, np.arange(0, n, block), axis=1)
        self._wanted = np.zeros(n_terms)
        self.opened = 0  # blocks opened so far

    def _slices(self, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        return np.repeat(first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, skip: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query (terms, weights) the positions and cosines above 0 of the k nearest, and of all as near
        as the last, by cosine and id. ``skip``: a position per query that is left out."""
        n = len(self.ids)
        total = np.zeros((len(queries), n))
        asked = np.zeros((len(queries), len(self.columns)))
        for i, (terms, weights) in enumerate(queries):
            self._add(total[i], asked[i], terms, weights)
        if skip is not None:
            total[np.arange(len(queries)), skip] = -np.inf
        # What the examples have so far only grows, so the k-th of it is a threshold, and a
        # block's maxima bound what the common terms can add there.
        reach = np.maximum.reduceat(total, np.arange(0, n, self.block), axis=1) + asked @ self.maxima
        able = reach >= self._kth(total, k)[:, None] - 1e-9
        few = able.sum(axis=1) <= max(1, self.n_blocks // 64)
        most = np.flatnonzero(~few)
        if len(most):  # their common terms in one product over all blocks
            total[most] += asked[most] @ self.columns
        out = []
        for i, (terms, weights) in enumerate(queries):
            if few[i]:
                self.opened += int(able[i].sum())
                here = (np.flatnonzero(able[i])[:, None] * self.block + np.arange(self.block)).ravel()
                here = here[(here < n) & (here != (-1 if skip is None else skip[i]))]
                out.append(self._nearest(here, self._exact(here, terms, weights), k))
            else:
                self.opened += self.n_blocks
                here = np.flatnonzero(total[i] > 0)
                out.append(self._nearest(here, total[i][here], k))
        return out

    def _add(self, total: np.ndarray, asked: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        """Add a query's rare terms to its totals, and put its common ones beside."""
        column = self.column[terms]
        often = column >= 0
        asked[column[often]] = weights[often]
        terms, weights = terms[~often], weights[~often]
        size = self.df[terms]
        long = size > _LOOP
        few = size[~long]
        at = self._slices(self.post_first[terms[~long]], few)
        total += np.bincount(self.posts[at], self.post_weights[at] * np.repeat(weights[~long], few), minlength=len(total))
        first = self.post_first[terms[long]]
        for p, q, w in zip(first.tolist(), (first + size[long]).tolist(), weights[long].tolist()):
            total[self.posts[p:q]] += w * self.post_weights[p:q]

    @staticmethod
    def _kth(total: np.ndarray, k: int) -> np.ndarray:
        n = total.shape[1]
        return np.maximum(np.partition(total, n - k, axis=1)[:, n - k], 0) if n >= k else np.zeros(len(total))

    def _exact(self, here: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Cosines of some examples from their vectors."""
        self._wanted[terms] = weights
        size = self.sizes[here]
        at = self._slices(self.first[here], size)
        found = np.bincount(np.repeat(np.arange(len(here)), size), self.weights[at] * self._wanted[self.terms[at]], minlength=len(here))
        self._wanted[terms] = 0.0
        return found

    def _nearest(self, here: np.ndarray, cosines: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(here) > k:  # the rounding comes after, on the few that are left
            keep = cosines >= np.partition(cosines, len(cosines) - k)[len(cosines) - k] - 1e-9
            here, cosines = here[keep], cosines[keep]
        cosines = np.round(cosines, 9)
        keep = cosines > 0
        if len(here) > k:
            keep &= cosines >= np.partition(cosines, len(cosines) - k)[len(cosines) - k]
        here, cosines = here[keep], cosines[keep]
        order = np.lexsort((self.ids[here], -cosines))
        return here[order], cosines[order]


class Model:
    """Examples, document frequencies and the curve. Travels as counts of terms; workers index them."""

    def __init__(self, factor: np.ndarray, idf: np.ndarray, examples: tuple, y: np.ndarray, weights: np.ndarray, bare: float, k: int = NEIGHBOURS):
        self.factor, self.idf, self.k = factor, idf, k
        self.weights = weights  # by label: share in all labelled rows over share in the sample
        self.bare = bare  # score of a text with none of the terms
        self.slope, self.shift = 1.0, 0.0
        self._examples, self._y = examples, y  # (terms, counts, sizes, ids) and their labels
        self._index()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("index", "labels")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._index()
        self._examples = None  # a worker has the index instead

    def _index(self) -> None:
        terms, counts, sizes, ids = self._examples
        self.index = self.labels = None
        if len(terms):
            weights = np.sqrt(counts.astype(np.float64)) * (self.idf * self.factor)[terms]
            owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            weights /= np.sqrt(np.bincount(owner, weights * weights, minlength=len(sizes)))[owner]
            del owner
            self.index = BlockMaxIndex(terms, weights, sizes, ids, len(self.idf))
            self.labels = self._y[np.argsort(self.index.position)]

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """TF-IDF of unit length."""
        raw = np.sqrt(counts) * self.idf[terms] * self.factor[terms]
        return raw / np.sqrt(raw @ raw)

    def votes(self, vectors: list[tuple[np.ndarray, np.ndarray]], skip: list[int] | None = None) -> list[tuple]:
        """Per (terms, counts): the weighted share of toxic neighbours (None: no neighbour), and the neighbours."""
        if self.index is None:
            return [(None, [])] * len(vectors)
        queries = []
        for terms, counts in vectors:
            order = np.argsort(terms)  # a fixed order of summation
            terms = terms[order]
            weights = self.vector(terms, counts[order]) if len(terms) else np.zeros(0)
            known = terms < len(self.idf) - 1  # the last one stands for words that no example has
            queries.append((terms[known], weights[known]))
        out = []
        for near, cosines in self.index.search(queries, self.k, skip):
            if not len(near):
                out.append((None, []))
                continue
            y = self.labels[near]
            w = cosines * cosines * self.weights[y]
            out.append((float((w * y).sum() / w.sum()), list(zip(near[: self.k].tolist(), cosines[: self.k].tolist()))))
        return out

    def scores(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, list[tuple[int, float]]]]:
        def curve(vote: float) -> float:
            return float(1 / (1 + np.exp(-np.clip(self.slope * logit(vote) + self.shift, -30, 30))))

        return [(self.bare if vote is None else curve(vote), near) for vote, near in self.votes(vectors)]


def logit(p):
    p = np.clip(p, 0.005, 0.995)
    return np.log(p / (1 - p))


def fit_curve(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of y on x by Newton steps, with a little ridge."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        r, h = w * (y - p), w * p * (1 - p)
        g = np.array([(r * x).sum() - 0.1 * (a - 1), r.sum() - 0.1 * b])
        m = np.array([[(h * x * x).sum() + 0.1, (h * x).sum()], [(h * x).sum(), h.sum() + 0.1]])
        step = np.linalg.solve(m, g)
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-9:
            break
    return max(float(a), 0.1), float(b)


def _labelled(labels: DataFrame) -> DataFrame:
    """One row per document of the training folds: id, y."""
    rows = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("y"))
    rows = rows.where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & (fold_of(F.col("id")) != 0))
    return rows.groupBy("id").agg(F.max("y").alias("y"))


def _sample(docs: DataFrame, train: DataFrame, examples: int) -> DataFrame:
    """The examples' texts: at most ``examples`` documents per class."""
    parts = [
        train.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(examples) for y in (0, 1)
    ]
    ids = store.write_shared(parts[0].unionByName(parts[1]), "tox-ids")
    # At most 2 * examples ids of 12 bytes: the broadcast has a fixed bound.
    found = docs.join(F.broadcast(ids), docs["doc_id"] == ids["id"]).select("id", "y", "text")
    # Of rows that repeat an id with different texts the smallest text is the example.
    found = found.groupBy("id").agg(F.max("y").alias("y"), F.min("text").alias("text"))
    return store.write_shared(found, "tox-sample")


def _terms(sample: DataFrame) -> Terms:
    """All words of the examples, and the telling terms among words and word beginnings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for b in batches:
            for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for t in text_terms(text):
                    counts.setdefault(t, [0, 0])[y] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string())]
            + [pa.array([c[y] for c in counts.values()], pa.int64()) for y in (0, 1)],
            names=["term", "n0", "n1"],
        )

    texts = store.write_shared(sample.dropDuplicates(["y", "text"]).select("y", "text"), "tox-texts")
    totals = {r[0]: r[1] for r in texts.groupBy("y").count().collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    # Many small tasks: each holds the terms of its texts.
    counted = texts.repartition(TERM_TASKS).mapInArrow(run, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counted = store.write_shared(counted, "tox-terms")
    # Bounded by the texts of the examples.
    words = counted.where(~F.col("term").endswith("*")).select("term").orderBy("term").toArrow().column(0).to_pylist()
    if not n0 or not n1:
        return Terms(words, [])
    a, b, both = F.col("n1"), F.col("n0"), F.col("n0") + F.col("n1")
    n = float(n0 + n1)
    # Log-likelihood ratio of term and label: p is about exp(-g / 2), also for rare terms.
    gain = 2 * (a * F.log(a * n / (both * n1)) + F.when(b > 0, b * F.log(b * n / (both * n0))).otherwise(0.0))
    frequent = counted.where(F.col("n1") >= LEAST_COUNT)
    tests = max(1, frequent.count())
    telling = frequent.where((a / n1 > 2 * b / n0) & (gain >= 2 * (math.log(tests) + MARGIN))).orderBy("term")
    return Terms(words, [r["term"] for r in telling.select("term").collect()])


def _counts(docs: DataFrame, terms: Terms, columns: str) -> DataFrame:
    """``columns`` of docs with the counts of the terms in the whole text as parallel arrays."""
    names = [c.split()[0] for c in columns.split(", ")]
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # bounded by the texts of the examples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            terms, counts = [_NO_TERMS], [_NO_TERMS]
            for text in b.column(len(names)).to_pylist():
                found = known.of(text)
                terms.append(np.fromiter(found, dtype=np.int32, count=len(found)))
                counts.append(np.fromiter(found.values(), dtype=np.int32, count=len(found)))
            offsets = pa.array(np.cumsum([len(t) for t in terms]).astype(np.int32))
            flat = [pa.array(np.concatenate(v)) for v in (terms, counts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(names))] + [pa.ListArray.from_arrays(offsets, v) for v in flat],
                names=[*names, "terms", "counts"],
            )

    return docs.select(*names, "text").mapInArrow(run, f"{columns}, terms array<int>, counts array<int>")


def _vectors_of(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(terms, counts) of each row, without Python objects per entry."""
    t, c = (b.column(x) for x in ("terms", "counts"))
    ends = np.cumsum(t.value_lengths().to_numpy())
    terms, counts = t.flatten().to_numpy(), c.flatten().to_numpy()
    for i, j in zip([0, *ends.tolist()], ends.tolist()):
        yield terms[i:j], counts[i:j]


def fit(vectors: DataFrame, sample: DataFrame, train: DataFrame, terms: Terms, k: int) -> tuple[Broadcast, tuple[float, float]]:
    """The model from all documents' term counts and the examples, and its curve."""
    spark = vectors.sparkSession
    n_docs = vectors.count()
    df = np.zeros(terms.size)
    found = vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()  # a row per term
    df[found.column(0).to_numpy()] = found.column(1).to_numpy()
    idf = np.log((n_docs + 1) / (df + 1)) + 1
    totals = {r[0]: r[1] for r in train.groupBy("y").count().collect()}
    examples = store.write_shared(_counts(sample, terms, "id long, y int"), "tox-examples")
    rows = examples.orderBy("id").toArrow().combine_chunks()  # <= 2 * EXAMPLES texts' counts
    y, ids = rows.column("y").to_numpy().astype(np.int64), rows.column("id").to_numpy()
    weights = np.array([totals.get(c, 0) / max(1, int((y == c).sum())) for c in (0, 1)])
    share = float((weights[y] * y).sum() / weights[y].sum()) if len(y) else 0.0
    sizes, flat_terms, flat_counts = [], [], []
    for b in rows.to_batches():
        for t, c in _vectors_of(b):
            order = np.argsort(t)
            flat_terms.append(t[order])
            flat_counts.append(c[order])
            sizes.append(len(t))
    flat = [np.concatenate(x) if x else np.zeros(0, dtype=np.int32) for x in (flat_terms, flat_counts)]
    flat[1] = flat[1].astype(np.min_scalar_type(int(flat[1].max(initial=0))))
    model = Model(terms.factor, idf, (*flat, np.array(sizes, dtype=np.int64), ids), y, weights, share, k)
    shared = spark.sparkContext.broadcast(model)  # the counts of at most 2 * EXAMPLES texts
    return shared, calibrate(examples, model, shared)


def calibrate(examples: DataFrame, model: Model, shared: Broadcast) -> tuple[float, float]:
    """The curve of the leave-one-out votes, computed by tasks over the bounded examples."""
    if model.index is None:
        return model.slope, model.shift

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {i: p for p, i in enumerate(shared.value.index.ids.tolist())}
        for b in batches:
            ids, vectors, votes = b.column("id").to_pylist(), list(_vectors_of(b)), []
            for i in range(0, len(ids), QUERIES):
                part = vectors[i : i + QUERIES]
                votes += [v for v, _ in shared.value.votes(part, [at[x] for x in ids[i : i + QUERIES]])]
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(votes, pa.float64())], names=["y", "v"])

    rows = examples.repartition(12).mapInArrow(run, "y int, v double").where("v is not null").collect()
    rows.sort(key=lambda r: (r["v"], r["y"]))  # a fixed order of summation
    if not rows:
        return model.slope, model.shift
    y = np.array([r["y"] for r in rows])
    return fit_curve(logit(np.array([r["v"] for r in rows])), y, model.weights[y] / model.weights[y].mean())


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    examples: int = EXAMPLES,
    k: int = NEIGHBOURS,
    key_col: str | None = None,
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted, evidence (neighbour id and cosine).

    ``key_col``: a long column that is carried along, to tell rows apart.
    """
    spark = docs.sparkSession
    store.python_ready(spark)
    carried = [key_col] if key_col else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carried)
    train = store.write_shared(_labelled(labels), "tox-train")
    sample = _sample(rows, train, examples)
    terms = _terms(sample)
    vectors = store.write_shared(_counts(rows, terms, ", ".join(f"{c} long" for c in ["doc_id", *carried])), "tox-vectors")
    shared, curve = fit(vectors, sample, train, terms, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        model.slope, model.shift = curve
        seen: dict[tuple, tuple] = {}  # equal vectors have equal scores
        for b in batches:
            vectors = list(_vectors_of(b))
            keys = [(t.tobytes(), c.tobytes()) for t, c in vectors]
            if len(seen) > KEPT_SCORES:
                seen.clear()
            new = list({key: v for key, v in zip(keys, vectors) if key not in seen}.items())
            for i in range(0, len(new), QUERIES):
                for (key, _), (score, near) in zip(new[i : i + QUERIES], model.scores([v for _, v in new[i : i + QUERIES]])):
                    seen[key] = score, [{"doc_id": int(model.index.ids[p]), "cosine": s} for p, s in near]
            out = [seen[key] for key in keys]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([s for s, _ in out], pa.float64()),
                    pa.array([e for _, e in out], pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())]))),
                    *[b.column(c) for c in carried],
                ],
                names=["doc_id", "score", "evidence", *carried],
            )

    schema = "doc_id long, score double, evidence array<struct<doc_id: bigint, cosine: double>>"
    scored = vectors.mapInArrow(run, ", ".join([schema, *[f"{c} long" for c in carried]]))
    held = F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False))
    return scored.select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", *carried
    )
