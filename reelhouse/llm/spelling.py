"""Spelling variants: words one edit apart, found in a trie over letter-group counts.

Every word has a frequency vector: how many of its letters fall into each of
``GROUPS``. One inserted or deleted letter changes one count by one; one
replaced letter raises at most one count and lowers at most one. So a word's
near words lie where a descent of the trie of vectors (one level per group)
spends at most one surplus and one deficit. Each unordered pair is found once:
the surplus has to be spent first, which the pair's other direction satisfies
when this one does not.

The trie is spread over the cluster. Its upper levels are tables of nodes
(vector prefix, words below): a node of at most ``leaf_words`` words is a
subtree that one task owns, a larger one is opened a few levels deeper, down
to the whole vector and then to halves of the spelling (two words one edit
apart share their first or their last half). Queries descend through these
tables by joins, which drop every branch that does not exist. In the tasks a
depth-first search over the subtree carries all queries that are still within
their budget, and the words at the leaves it reaches are verified letter by
letter. A subtree is held by its task, the queries to it pass in batches.

Counting: runs of a document are counted in the task (a run's deletion
depends only on the document and the run, so once per distinct run), then per
word by a combined aggregate, so a word in a third of all runs is no hot key.

Defined results. Null or empty text: no runs. A null id writes as an empty
one. Repeated rows count again. Very long texts and runs are read whole. Ties
between forms go to the smallest word by code points. Extra columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import store

# Fixed values of the contract.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")  # UTF-8 of [a-zÀ-ÿ]
DELETE_MODULUS = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_RATIO = 5

# Letter groups, one trie level each; letters outside of a-z share the last one.
GROUPS = ("e", "t", "a", "o", "i", "n", "s", "r", "h", "l", "d", "u", "c", "m", "p", "g", "bfvw", "jkqxyz", "")
# Trie levels of the node tables.
LEVELS = (4, 8, 12, 16, len(GROUPS))
# A node with more words than this is opened deeper.
LEAF_WORDS = 2_000
# Queries of a subtree beyond this go to further tasks.
QUERY_ROWS = 50_000
# Words a counting task holds before it passes them on.
HELD_WORDS = 400_000
# Trie ranges up to this many vectors are compared at once.
_SMALL = 12
_BLOCK_BYTES = 1 << 22
_LESS = np.uint8(255)  # minus one, as counts are kept modulo 256
_PAIRS = 1 << 16  # word pairs verified at a time

_GROUP_OF = np.full(256, len(GROUPS) - 1, dtype=np.uint8)
for _i, _letters in enumerate(GROUPS):
    for _c in _letters:
        _GROUP_OF[ord(_c)] = _i


# --- counting -------------------------------------------------------------------


def document_words(doc_id: int | None, text: bytes | None) -> Counter:
    """Words of one text in UTF-8, as bytes, with their number."""
    found: Counter = Counter()
    seed = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    for run, n in Counter(RUN.findall((text or b"").lower())).items():
        h = zlib.crc32(run, seed)
        if h % DELETE_MODULUS == 0:
            letters = run.decode()
            at = h % len(letters)
            run = (letters[:at] + letters[at + 1 :]).encode()
        found[run] += n
    return found


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of at least ``LEAST_LETTERS`` letters and ``LEAST_COUNT`` occurrences."""
    store.python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = [(w.decode(), n) for w, n in held.items()]
            words = [(w, n) for w, n in words if len(w) >= LEAST_LETTERS]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in words], pa.string()), pa.array([n for _, n in words], pa.int64())], ["word", "n"]
            )

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                for w, n in document_words(i, t).items():
                    held[w] += n
                if len(held) > HELD_WORDS:
                    yield out()
        yield out()

    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


# --- vectors and the node tables ------------------------------------------------


def vectors(words: list[str]) -> np.ndarray:
    """Frequency vectors, a row per word; counts are kept modulo 256, as differences of one are."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    letters = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    row = np.repeat(np.arange(len(words)), size)
    flat = np.bincount(row * len(GROUPS) + _GROUP_OF[letters], minlength=len(words) * len(GROUPS))
    return (flat & 255).astype(np.uint8).reshape(len(words), len(GROUPS))


def _binary(rows: np.ndarray) -> pa.Array:
    """Fixed-width rows of bytes as an Arrow binary array."""
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(
        pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())]
    )


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint8).reshape(len(col), width)


def _add_vectors(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = _binary(vectors(b.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), vec], ["word", "n", "vec"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, vec binary")


def steps(width: int, state: int) -> tuple[np.ndarray, np.ndarray]:
    """Changes of ``width`` counts a descent may make from a state, and the states after them.

    State 0: nothing spent, 1: the surplus, 2: surplus and deficit.
    """
    out = [(np.zeros(width, dtype=np.uint8), state)]
    for i in range(width):
        if state == 0:
            up = np.zeros(width, dtype=np.uint8)
            up[i] = 1
            out.append((up, 1))
            for j in range(i + 1, width):
                both = up.copy()
                both[j] = _LESS
                out.append((both, 2))
        elif state == 1:
            down = np.zeros(width, dtype=np.uint8)
            down[i] = _LESS
            out.append((down, 2))
    return np.array([d for d, _ in out]), np.array([s for _, s in out], dtype=np.int32)


def _descend(queries: DataFrame, level: int, deeper: int) -> DataFrame:
    """Queries at nodes of ``level`` opened to all prefixes of ``deeper`` within their budget."""
    moves = {s: steps(deeper - level, s) for s in (0, 1, 2)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            vec = _matrix(b.column(2), len(GROUPS))
            node = _matrix(b.column(3), level)
            state = b.column(4).to_numpy()
            for s, (delta, after) in moves.items():
                at = np.flatnonzero(state == s)
                if not len(at):
                    continue
                i, m = np.repeat(at, len(delta)), np.tile(np.arange(len(delta)), len(at))
                prefix = np.concatenate([node[i], vec[i, level:deeper] + delta[m]], axis=1)
                take = pa.array(i)
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).take(take) for k in range(3)] + [_binary(prefix), pa.array(after[m], pa.int32())],
                    ["word", "n", "vec", "node", "state"],
                )

    rows = queries.select("word", "n", "vec", "node", "state")
    return rows.mapInArrow(run, "word string, n long, vec binary, node binary, state int")


def _by_halves(rows: DataFrame, query: bool) -> DataFrame:
    """Rows of nodes that hold too many words of one vector, dealt by halves of the spelling.

    Two words one edit apart share the first half or the rest of the shorter
    one. A query keys by its own length; a word by that of the query it would
    meet: its own (replaced letter) or one less (inserted letter).
    """
    parts = []
    for longer in (False, True):
        part = rows.where((F.col("state") == 1) == F.lit(longer)) if query else rows
        size = F.length("word") - int(longer and not query)
        part = part.withColumn("_h", F.floor(size / 2).cast("int")).withColumn("_t", size.cast("int") - F.col("_h"))
        for kind, half in (("p", "left(word, _h)"), ("s", "right(word, _t)")):
            node = F.concat("node", F.lit(f"/{int(longer)}{kind}").cast("binary"), F.expr(half).cast("binary"))
            parts.append(part.select("word", "n", "vec", node.alias("node"), "state", F.lit(kind).alias("kind")))
    return reduce(DataFrame.unionByName, parts)


def _rows(df: DataFrame, level: int, query: bool) -> DataFrame:
    """Columns of the compared rows; words carry no state."""
    state = F.col("state") if query else F.lit(0)
    kind = F.col("kind") if "kind" in df.columns else F.lit("")
    return df.select(
        F.lit(level).alias("level"), "node", kind.alias("kind"), F.lit(query).alias("query"), "word", "n", "vec", state.alias("state")
    )


def _subtrees(words: DataFrame, leaf_words: int) -> tuple[DataFrame, DataFrame]:
    """The words of all owned subtrees, and the queries that reach them."""
    rest, level = words, 0
    queries = words.select("word", "n", "vec", F.lit(b"").alias("node"), F.lit(0).alias("state"))
    owned, asked = [], []
    for deeper in LEVELS:
        placed = rest.withColumn("node", F.expr(f"substring(vec, 1, {deeper})"))
        nodes = placed.groupBy("node").agg((F.count(F.lit(1)) > leaf_words).alias("open"))
        nodes = store.write_shared(nodes, "spelling-nodes")
        placed = store.write_shared(placed.join(nodes, "node"), "spelling-words")
        reached = store.write_shared(_descend(queries, level, deeper).join(nodes, "node"), "spelling-queries")
        owned.append(_rows(placed.where("not open"), deeper, False))
        asked.append(_rows(reached.where("not open"), deeper, True))
        rest, queries, level = placed.where("open").drop("open"), reached.where("open").drop("open"), deeper
        if nodes.where("open").isEmpty():
            break
    else:
        owned.append(_rows(_by_halves(rest.withColumn("state", F.lit(0)), False), level, False))
        asked.append(_rows(_by_halves(queries, True), level, True))
    return reduce(DataFrame.unionByName, owned), reduce(DataFrame.unionByName, asked)


# --- depth-first search and verification ------------------------------------------


def search(trie: np.ndarray, queries: np.ndarray, state: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, int]]:
    """(query rows, trie row) within the budget, by depth-first search.

    ``trie``: distinct vectors in ascending order, so that a trie node is a
    range of rows and its children are the runs of the next column.
    """
    width = trie.shape[1]
    stack = [(0, len(trie), level, np.arange(len(queries)), state)]
    while stack:
        lo, hi, at, alive, spent = stack.pop()
        if hi - lo <= _SMALL or at == width:
            for row in range(lo, hi):
                d = trie[row, at:] - queries[alive, at:]
                up, down = d == 1, d == _LESS
                n_up, n_down = up.sum(axis=1), down.sum(axis=1)
                ok = (up | down | (d == 0)).all(axis=1)
                # Surplus only if unspent; the deficit once, and only after the surplus.
                ok &= (n_up <= (spent == 0)) & (n_down <= (spent < 2)) & ((n_down == 0) | (spent == 1) | (n_up == 1))
                both = ok & (n_up == 1) & (n_down == 1)
                if both.any():
                    ok &= ~both | (up.argmax(axis=1) < down.argmax(axis=1))
                hit = alive[ok]
                if len(hit):
                    yield hit, row
            continue
        column = trie[lo:hi, at]
        cuts = np.flatnonzero(np.diff(column)) + 1
        for p, q in zip([0, *cuts], [*cuts, hi - lo]):
            d = column[p] - queries[alive, at]
            after = np.where(d == 0, spent, np.where((d == 1) & (spent == 0), 1, np.where((d == _LESS) & (spent == 1), 2, -1)))
            keep = after >= 0
            if keep.any():
                stack.append((lo + int(p), lo + int(q), at + 1, alive[keep], after[keep]))


class _Letters:
    """Words as one byte string (their letters are all below U+0100)."""

    def __init__(self, words: list[str]):
        self.size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.start = np.cumsum(self.size) - self.size
        self.letters = np.frombuffer("".join(words).encode("latin-1") + b"\0", dtype=np.uint8)

    def rows(self, at: np.ndarray, width: int) -> np.ndarray:
        column = np.arange(width)
        inside = column[None] < self.size[at][:, None]
        where = np.where(inside, self.start[at][:, None] + column[None], len(self.letters) - 1)
        return np.where(inside, self.letters[where], 0)


def one_edit(a: _Letters, ai: np.ndarray, b: _Letters, bi: np.ndarray) -> np.ndarray:
    """Which pairs differ by exactly one replaced letter, or by one letter that b has more."""
    out = np.zeros(len(ai), dtype=bool)
    more = b.size[bi] - a.size[ai]
    order = np.argsort(b.size[bi], kind="stable")
    order = order[(more[order] == 0) | (more[order] == 1)]
    lo = 0
    while lo < len(order):
        hi = min(len(order), lo + max(1, _BLOCK_BYTES // int(b.size[bi[order[lo]]] + 1)))
        at = order[lo:hi]
        wide = int(b.size[bi[at[-1]]])
        while len(at) > 1 and wide * len(at) > 2 * _BLOCK_BYTES:  # a much longer word ends the block earlier
            at = at[: len(at) // 2]
            wide = int(b.size[bi[at[-1]]])
        left, right = a.rows(ai[at], wide), b.rows(bi[at], wide)
        same = left == right
        replaced = (more[at] == 0) & ((~same).sum(axis=1) == 1)
        # Inserted: the shorter word equals the longer without its first differing letter.
        first = np.where(same.all(axis=1), wide, same.argmin(axis=1))
        shifted = left[:, :-1] == right[:, 1:] if wide > 1 else np.ones((len(at), 0), dtype=bool)
        inserted = (more[at] == 1) & (shifted | (np.arange(wide - 1)[None] < first[:, None])).all(axis=1)
        out[at] = replaced | inserted
        lo += len(at)
    return out


class _Subtree:
    """The words of one owned node, ordered by the rows of its trie."""

    def __init__(self, batches: list[pa.RecordBatch]):
        t = pa.Table.from_batches(batches).combine_chunks()
        self.words = t.column("word").to_pylist()
        self.letters = _Letters(self.words)
        self.n = t.column("n").to_numpy()
        self.trie, group = np.unique(_matrix(t.column("vec"), len(GROUPS)), axis=0, return_inverse=True)
        self.members = np.argsort(group.ravel(), kind="stable")
        self.first = np.searchsorted(group.ravel()[self.members], np.arange(len(self.trie) + 1))

    def near(self, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Near pairs of a batch of queries with the words here."""
        ask = b.column("word").to_pylist()
        letters = _Letters(ask)
        vec, n = _matrix(b.column("vec"), len(GROUPS)), b.column("n").to_numpy()
        level, kind = b.column("level")[0].as_py(), b.column("kind")[0].as_py()
        for hit, row in search(self.trie, vec, b.column("state").to_numpy(), level):
            members = self.members[self.first[row] : self.first[row + 1]]
            at_once = max(1, _PAIRS // len(members))
            for lo in range(0, len(hit), at_once):
                some = hit[lo : lo + at_once]
                qi, wi = np.repeat(some, len(members)), np.tile(members, len(some))
                ok = one_edit(letters, qi, self.letters, wi)
                qi, wi = qi[ok], wi[ok]
                both_ways = (vec[qi] == self.trie[row]).all(axis=1).tolist()
                found = []
                for i, j, twice in zip(qi.tolist(), wi.tolist(), both_ways):
                    a, w = ask[i], self.words[j]
                    if twice and a > w:  # words of one vector meet from both sides
                        continue
                    if kind == "s" and a[: len(a) // 2] == w[: len(a) // 2]:  # met by the first half
                        continue
                    found.append((a, n[i], w, self.n[j]))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["a", "a_n", "b", "b_n"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by node, a node's words before its queries; queries pass in batches."""
    key: tuple | None = None
    held: list[pa.RecordBatch] = []
    tree: _Subtree | None = None
    for b in batches:
        marks = list(zip(*(b.column(c).to_pylist() for c in ("level", "node", "chunk", "query"))))
        cuts = [0, *(i for i in range(1, len(marks)) if marks[i] != marks[i - 1]), len(marks)]
        for p, q in zip(cuts, cuts[1:]) if marks else ():
            if key != marks[p][:3]:
                key, held, tree = marks[p][:3], [], None
            if not marks[p][3]:
                held.append(b.slice(p, q - p))
            elif held:
                tree = tree or _Subtree(held)
                yield from tree.near(b.slice(p, q - p))


def near_words(words: DataFrame, leaf_words: int = LEAF_WORDS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(a, a_n, b, b_n): every unordered pair of near words of (word, n), once."""
    store.python_ready(words.sparkSession)
    owned, asked = _subtrees(store.write_shared(_add_vectors(words), "spelling-vectors"), leaf_words)
    # A subtree that many queries reach is given to several tasks, a share of the queries each.
    shares = asked.groupBy("level", "node").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("shares"))
    shares = store.write_shared(shares, "spelling-shares")
    owned = owned.join(shares, ["level", "node"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    asked = asked.join(shares, ["level", "node"]).withColumn("chunk", F.pmod(F.xxhash64("word"), "shares").cast("int"))
    keys = ["level", "node", "chunk"]
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = owned.unionByName(asked).drop("shares").repartition(n, *keys).sortWithinPartitions(*keys, "query")
    return rows.mapInArrow(_compare, "a string, a_n long, b string, b_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word reached by following forms. Counts rise by ``FORM_RATIO``
    along a chain, so chains are short; pointers double in every round."""
    now = store.write_shared(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        moved = now.join(ahead, now["root"] == ahead["_w"], "left").select(
            "word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")
        )
        moved = store.write_shared(moved, "spelling-roots")
        now = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return now


def group_words(words: DataFrame, leaf_words: int = LEAF_WORDS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of (word, n); words are distinct."""
    words = store.write_shared(words.select("word", "n"), "spelling-counts")
    pairs = store.write_shared(near_words(words, leaf_words, query_rows), "spelling-near")
    way = lambda w, o, m: F.struct(F.col(w).alias("word"), F.struct((-F.col(m)).alias("k"), F.col(o).alias("w")).alias("o"))
    both = pairs.select(F.explode(F.array(way("a", "b", "b_n"), way("b", "a", "a_n"))).alias("r")).select("r.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("o").alias("o"))
    is_form = -F.col("o.k") >= FORM_RATIO * F.col("n")
    told = words.join(best, "word", "left").select(
        "word",
        F.when(is_form, F.col("o.w")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, -F.col("o.k")).alias("form_n"),
    )
    told = store.write_shared(told, "spelling-told")
    roots = _roots(told.where("form is not null"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words of ``docs`` with their forms and roots."""
    return group_words(count_words(docs, id_col, text_col))
