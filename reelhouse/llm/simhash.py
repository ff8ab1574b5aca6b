"""SimHash near-dedup: bit-sliced comparison inside pigeonhole blocks.

Fingerprints (64 bits, 3-word shingles, XXH64) are computed once per row.
Distinct fingerprints are dealt to blocks: the 64 bits are cut into ``blocks``
fields, and two fingerprints within ``radius`` bits agree on at least
``blocks - radius`` fields, so each choice of that many fields is a table of
exact keys and every pair within the radius meets in some table.

Inside a block the fingerprints are stored as bit planes, 64 of them to a
machine word and one word array per bit. A query bit XOR a plane gives one
difference bit for 64 fingerprints; carry-save counters (a ones word, a twos
word, ... and a sticky overflow word) add it to 64 distances at once, and a
(query, word) pair is abandoned as soon as all its lanes exceed the radius.
Links inside a block leave it as a spanning forest, so a block of k near
copies emits k - 1 edges, not k * k / 2. A block of more than ``CHUNK``
fingerprints is dealt again: two of its fingerprints within the radius differ
in at most ``radius`` of the bits that its key leaves open, so they agree on
one of ``radius + 1`` parts of those, and each part is a longer key. This is
done up to ``REKEYS`` times; only a block that is large even then, so of
fingerprints that agree nearly everywhere, is split into chunks, each pair of
which is a task.

Nulls: a null text is an empty text with fingerprint zero, linked like any
other. A null id is kept in the result but is no component's smallest id
unless the component has no other. Repeated rows and copies share a
fingerprint. Very long texts are hashed in slices. Ties: a bit that half the
hashes have is 0. Extra columns are not read. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import graph, store

SHINGLE_WORDS = 3
RADIUS = 3
# Five fields of 12 or 13 bits: ten tables keyed by two fields (about 25 bits).
BLOCKS = 5
CHUNK = 4_096
REKEYS = 3
SEED = 42
_SLICE = 1 << 16  # shingles hashed at a time
_PAIRS = 1 << 17  # (query, word) pairs compared at a time
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, k: int = SHINGLE_WORDS) -> int:
    """SimHash of UTF-8 text: bytes.lower and bytes.split know ASCII only, as wanted."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - k + 1)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    start = np.concatenate([[0], np.cumsum(size[:-1] + 1)])
    end = (start + size)[min(k, len(words)) - 1 :]
    votes = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, _SLICE):
        pairs = zip(start[lo : min(n, lo + _SLICE)].tolist(), end[lo : lo + _SLICE].tolist())
        h = np.array([xxhash.xxh64_intdigest(joined[p:q], SEED) for p, q in pairs], dtype=np.uint64)
        votes += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits((votes * 2 > n).astype(np.uint8)).tobytes()
    return int.from_bytes(bits, "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the signed 64-bit fingerprint of every row."""
    store.python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, k) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], names=["doc_id", "fp"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def block_keys(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """Bit masks of the tables: each choice of ``blocks - radius`` fields."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    fields = [((1 << (q - p)) - 1) << p for p, q in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(fields, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def within(queries: np.ndarray, qword: np.ndarray, planes: np.ndarray, valid: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Carry-save comparison of (query, word) pairs: surviving pairs and their lanes within the radius.

    ``queries``/``qword``: one fingerprint and one word number per pair.
    ``planes[b, w]``: bit b of the 64 fingerprints of word w; ``valid[w]``: lanes in use.
    """
    width = radius.bit_length()
    pair = np.arange(len(queries))
    count = [np.zeros(len(queries), dtype=np.uint64) for _ in range(width)]
    over = ~valid[qword]
    for b in range(64):
        carry = planes[b][qword] ^ (np.uint64(0) - ((queries >> np.uint64(b)) & np.uint64(1)))
        for i in range(width):
            count[i], carry = count[i] ^ carry, count[i] & carry
        over |= carry
        if b % 8 == 7:
            live = over != _ALL
            if not live.all():
                pair, queries, qword, over = pair[live], queries[live], qword[live], over[live]
                count = [c[live] for c in count]
    # Lanes whose counter value exceeds the radius: a bitwise comparison with a constant.
    more, same = np.zeros_like(over), np.full_like(over, _ALL)
    for i in reversed(range(width)):
        if radius >> i & 1:
            same &= count[i]
        else:
            more |= same & count[i]
            same &= ~count[i]
    return pair, qword, ~(over | more)


def _forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index of each element's component, from batches of links."""
    root = np.arange(n)
    for a, b in links:
        while True:
            ra, rb = root[a], root[b]
            differ = ra != rb
            if not differ.any():
                break
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def block_links(group: np.ndarray, fp: np.ndarray, lane: np.ndarray, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links inside each block. Rows are sorted by ``group``.

    ``lane``: rows stored in the planes; ``query``: rows compared with them
    (both true for a block that is compared with itself).
    """
    li = np.flatnonzero(lane)
    qi = np.flatnonzero(query)
    if not len(li) or not len(qi):
        return fp[:0], fp[:0]
    n_groups = int(group[-1]) + 1
    lanes = np.bincount(group[li], minlength=n_groups)
    words = -(-lanes // 64)
    first_word = np.cumsum(words) - words
    rank = np.arange(len(li)) - (np.cumsum(lanes) - lanes)[group[li]]
    word, bit = first_word[group[li]] + rank // 64, (rank % 64).astype(np.uint64)
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    planes = np.empty((64, int(words.sum())), dtype=np.uint64)
    for b in range(64):
        planes[b] = np.bitwise_or.reduceat(((fp[li] >> np.uint64(b)) & np.uint64(1)) << bit, starts)
    valid = np.bitwise_or.reduceat(np.uint64(1) << bit, starts)
    per_query = words[group[qi]]

    def links() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ends = np.cumsum(per_query)
        lo = 0
        while lo < len(qi):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _PAIRS, "right")))
            reps = per_query[lo:hi]
            row = np.repeat(qi[lo:hi], reps)
            offset = np.arange(len(row)) - np.repeat(np.cumsum(reps) - reps, reps)
            pair, w, hit = within(fp[row], first_word[group[row]] + offset, planes, valid, radius)
            on = np.unpackbits(hit.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            p, lane_no = np.nonzero(on)
            other = li[starts[w[p]] + lane_no]
            own = row[pair[p]]
            keep = own != other
            yield own[keep], other[keep]
            lo = hi

    root = _forest(len(fp), links())
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return fp[linked], fp[root[linked]]


def _compare(radius: int):
    """Blocks come sorted by key; a block may span batches, so its tail is carried over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None

        def links(t: pa.Table) -> pa.RecordBatch:
            keys = [t.column(c).to_numpy() for c in ("mask", "key", "i", "j")]
            new = np.zeros(t.num_rows, dtype=bool)
            for k in keys:
                new |= np.diff(k, prepend=k[:1]) != 0
            own = t.column("own").to_numpy()
            fp = t.column("fp").to_numpy().view(np.uint64)
            a, b = block_links(np.cumsum(new), fp, own == keys[3], own == keys[2], radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([b])])
            t = t.combine_chunks()
            same = np.ones(t.num_rows, dtype=bool)
            for c in ("mask", "key", "i", "j"):
                v = t.column(c).to_numpy()
                same &= v == v[-1]
            tail = t.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            if tail:
                yield links(t.slice(0, tail))
            kept = t.slice(tail)
        if kept is not None and kept.num_rows:
            yield links(kept)

    return run


def longer_keys(mask: int, radius: int = RADIUS) -> list[int]:
    """The mask with each of ``radius + 1`` parts of the bits that it leaves open."""
    left = [b for b in range(64) if not mask >> b & 1]
    parts = [left[i :: radius + 1] for i in range(radius + 1)]
    return [mask | sum(1 << b for b in p) for p in parts if p]


def block_tasks(
    fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, chunk: int = CHUNK, rekeys: int = REKEYS
) -> DataFrame:
    """(fp, mask, key, own, i, j): the distinct fingerprints dealt to blocks; chunks i and j of a block meet."""
    spark = fps.sparkSession
    masks = block_keys(radius, blocks)
    key = F.col("fp").bitwiseAND(F.col("mask")).alias("key")
    dealt = fps.select("fp").distinct().select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    dealt = dealt.select("fp", "mask", key)
    none = F.lit(0)
    done: list[DataFrame] = []

    def large(df: DataFrame) -> DataFrame:
        sizes = df.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk)
        return store.write_shared(sizes.select("mask", "key", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")), "simhash-large")

    for _ in range(rekeys):
        hot = large(dealt)
        if hot.isEmpty():
            return reduce(DataFrame.unionByName, [*done, dealt.select("fp", "mask", "key", *[none.alias(c) for c in ("own", "i", "j")])])
        cold = dealt.join(hot, ["mask", "key"], "left_anti")
        done.append(cold.select("fp", "mask", "key", *[none.alias(c) for c in ("own", "i", "j")]))
        # The masks there are is a number that radius and blocks fix, not the data.
        longer = [(_signed(m), [_signed(x) for x in longer_keys(m, radius)]) for m in masks]
        masks = list(dict.fromkeys(m for x in masks for m in longer_keys(x, radius)))
        longer = F.broadcast(store.local_frame(spark, longer, mask=pa.int64(), longer=pa.list_(pa.int64())))
        dealt = dealt.join(hot, ["mask", "key"], "left_semi").join(longer, "mask")
        dealt = dealt.select("fp", F.explode("longer").alias("mask")).select("fp", "mask", key).distinct()
        dealt = store.write_shared(dealt, "simhash-rekeyed")
    parts = F.coalesce(F.col("chunks"), F.lit(1))
    rest = (
        dealt.join(large(dealt), ["mask", "key"], "left")
        .withColumn("own", F.pmod(F.xxhash64("fp"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select("fp", "mask", "key", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    return reduce(DataFrame.unionByName, [*done, rest])


def near_links(
    fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, chunk: int = CHUNK, rekeys: int = REKEYS
) -> DataFrame:
    """(a, b): links of distinct fingerprints that connect all pairs within ``radius`` bits."""
    tasks = block_tasks(fps, radius, blocks, chunk, rekeys)
    keys = ["mask", "key", "i", "j"]
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tasks.repartition(n, *keys).sortWithinPartitions(*keys, "fp").mapInArrow(_compare(radius), "a long, b long")


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    chunk: int = CHUNK,
) -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id is the smallest id reachable."""
    fps = store.write_shared(fingerprints(docs, id_col, text_col, k), "simhash")
    roots = graph.components(near_links(fps, radius, blocks, chunk))
    # One row per distinct fingerprint from here on, so no group of copies is a hot key.
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    nodes = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    nodes = store.write_shared(nodes, "simhash-nodes")
    lows = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = nodes.join(lows, "root").select("fp", "component_id")
    return fps.join(labels, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(col: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))
