"""Benchmark decontamination: size-partitioned MinHash containment search.

A benchmark item is short and a document can be long, so the Jaccard
similarity of the two says little; what counts is containment, the share of
the item's distinct 5-word shingles that the document has. The search keeps
the item side as a bottom-k MinHash sketch and streams every shingle of the
document past it (containment MinHash):

* Items are partitioned by size: class c holds items of ``2**c`` to
  ``2**(c+1) - 1`` distinct shingles. The class fixes the sketch size, the
  ``u - ceil(t * u) + 1`` smallest shingle hashes for its largest size u.
* A document with containment t or more misses at most ``n - ceil(t * n)``
  shingles of an item of n, so it has at least one hash of the sketch: the
  candidate search loses nothing, whatever the document's length.
* Every candidate is verified by exact containment of the shingles as strings.

Items, sketches and shingles are tables made by tasks. One pass over the
documents takes out the shingles that may be an item's, told by a filter of
``FILTER_BITS`` bits (its size does not depend on the benchmark's; a fuller
filter only lets more shingles through), and the joins with sketches and
shingles are Spark's, by measured size. Texts are never shuffled.

Words are maximal runs of letters and digits of the lower-cased text. An item
of fewer than five words is one shingle, its whole word sequence, and is
looked for in the documents' windows of as many words; an item without words
is never contained, nor is one longer than the document. Nulls: a null text
has no words; a null item id or document id is carried as it is. Repeated
items or documents give repeated rows; ties cannot arise. Very long texts are
read whole. Empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import store

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
# Bits of the filter that tells a document's shingles apart: 2 MB in every task.
FILTER_BITS = 1 << 24
# Word hashes a worker remembers before it starts afresh.
CACHE_WORDS = 150_000

_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles(ws: list[str], k: int = SHINGLE_WORDS) -> set[str]:
    """Distinct runs of k words; none where there are fewer."""
    return {" ".join(ws[i : i + k]) for i in range(len(ws) - k + 1)}


class WordHashes:
    """64-bit word hashes with a bounded memory."""

    def __init__(self, limit: int = CACHE_WORDS):
        self.known: dict[str, int] = {}
        self.limit = limit

    def of(self, ws: list[str]) -> np.ndarray:
        import xxhash

        known = self.known
        try:
            got = [known[w] for w in ws]
        except KeyError:
            if len(known) > self.limit:
                known.clear()
            for w in set(ws):
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            got = [known[w] for w in ws]
        return np.array(got, dtype=np.uint64)


def shingle_hashes(h: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Hash of every run of k words from the word hashes."""
    n = max(0, len(h) - k + 1)
    out = np.full(n, 0x9E3779B97F4A7C15, dtype=np.uint64)
    for i in range(k):
        out = (out ^ h[i : i + n]) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(33)
    return out


def needed(n: int, t: float) -> int:
    """Shingles of an item of n that a document must have: ceil(t * n), exact for decimals like 0.8."""
    return max(1, -int(-round(t * n * 10**6) // 10**6))


def sketch_size(n: int, t: float) -> int:
    """Bottom-k size of the item's size class (its largest member decides)."""
    largest = (1 << n.bit_length()) - 1
    return largest - needed(largest, t) + 1


def _items(benchmark: DataFrame, k: int, t: float) -> DataFrame:
    """(item_id, k, shingles, hashes, sketch) of every item that has words; short items have a k of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for b in batches:
            rows = []
            for item_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ws = words(text)
                if not ws:
                    continue
                size = min(k, len(ws))
                own = sorted(shingles(ws, size))
                h = [int(shingle_hashes(memory.of(s.split(" ")), size)[0]) for s in own]
                low = sorted(h)[: sketch_size(len(h), t)]
                signed = [[x - (1 << 64) if x >> 63 else x for x in v] for v in (h, low)]
                rows.append((item_id, size, own, *signed))
            cols = list(zip(*rows)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(cols, types)], ["item_id", "k", "shingles", "hashes", "sketch"])

    return benchmark.mapInArrow(run, "item_id long, k int, shingles array<string>, hashes array<long>, sketch array<long>")


def _filter_words(hashes: DataFrame) -> dict[int, bytes]:
    """Per shingle size the filter of the items' shingle hashes (k, h)."""
    bit = F.col("h").bitwiseAND(FILTER_BITS - 1)
    words_ = hashes.groupBy("k", F.shiftright(bit, 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits")
    )
    out: dict[int, np.ndarray] = {}
    for r in words_.collect():  # at most FILTER_BITS / 64 rows per size, whatever the benchmark
        out.setdefault(r["k"], np.zeros(FILTER_BITS // 64, dtype=np.int64))[r["w"]] = r["bits"]
    return {k: v.tobytes() for k, v in out.items()}


def _hits(docs: DataFrame, filters: dict[int, bytes]) -> DataFrame:
    """(row, doc_id, k, h, shingle): distinct shingles of each document that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # FILTER_BITS bits for each of at most k sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        bits = {k: np.frombuffer(v, dtype=np.uint8) for k, v in shared.value.items()}
        for b in batches:
            rows = []
            for row, doc_id, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                ws = words(text)
                known = memory.of(ws) if ws else None
                for k, passes in bits.items():
                    if len(ws) < k:
                        continue
                    h = shingle_hashes(known, k)
                    bit = (h & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                    at = np.flatnonzero(passes[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
                    if len(at):
                        found = {" ".join(ws[i : i + k]): x for i, x in zip(at.tolist(), h[at].view(np.int64).tolist())}
                        rows += [(row, doc_id, k, x, s) for s, x in found.items()]
            cols = list(zip(*rows)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(cols, types)], ["row", "doc_id", "k", "h", "shingle"])

    return docs.mapInArrow(run, "row long, doc_id long, k int, h long, shingle string")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = SHINGLE_WORDS,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per (document, item) pair whose containment reaches the threshold."""
    store.python_ready(docs.sparkSession)
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    items = store.write_shared(_items(items, k, containment), "decon-items")
    # Items with the same shingles are searched once.
    sets = items.dropDuplicates(["k", "shingles"]).select(F.monotonically_increasing_id().alias("item"), "k", "shingles", "hashes", "sketch")
    sets = store.write_shared(sets, "decon-sets")
    members = items.join(sets.select("item", "k", "shingles"), ["k", "shingles"]).select("item", "item_id", F.size("shingles").alias("n"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    hits = _hits(rows, _filter_words(sets.select("k", F.explode("hashes").alias("h"))))
    hits = store.write_shared(hits, "decon-hits")
    # The search: a document that contains an item has one of its sketch's hashes.
    sketches = sets.select("k", "item", F.explode("sketch").alias("h"))
    candidates = hits.select("row", "k", "h").join(sketches, ["k", "h"]).select("row", "item").distinct()
    # The check: shingles that document and item share, as strings.
    own = sets.select("k", "item", F.explode("shingles").alias("shingle"))
    shared = hits.join(own, ["k", "shingle"]).groupBy("row", "item").agg(F.count(F.lit(1)).alias("matched"), F.first("doc_id").alias("doc_id"))
    found = shared.join(candidates, ["row", "item"], "left_semi").join(members, "item")
    # matched >= ceil(t * n), exact for decimals like 0.8 (see needed).
    least = F.ceil(F.round(F.lit(containment) * F.col("n"), 6))
    return found.where(F.col("matched") >= F.greatest(F.lit(1), least)).select(
        "doc_id", "item_id", F.col("matched").cast("int").alias("matched"), F.col("n").alias("item_shingles"),
        (F.col("matched") / F.col("n")).alias("containment"),
    )
