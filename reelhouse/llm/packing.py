"""Best-fit packing of token sequences.

Best-fit decreasing over a histogram: pieces of equal length are
interchangeable, so the packing depends only on how many pieces there are of
each length (at most ``capacity`` numbers, whatever the corpus size). Lengths
go in decreasing order; a segment tree over remaining capacities holds the
number of open bins at each capacity and finds the tightest one that still
takes the length in logarithmic time. All bins in the same state are filled in
one step, which gives exactly the bins that placing documents one by one
gives. The plan is a small table of runs: pieces number ``first`` onwards of a
length go to bins ``bin`` onwards, ``per_bin`` to each, from ``offset``.

Spark does the rest: tokenising in tasks (word cache over the tokenizer),
numbering the pieces of each length (by length and hash bucket, so that a
length held by a third of all pieces is numbered by many tasks), and one range
join of those numbers with the plan.

Nulls: a null text is an empty one (its single id is the end mark). A null id
is carried. Repeated rows are separate documents. Very long texts are cut into
full pieces. Ties (pieces of equal length) go by hash bucket and are
interchangeable. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse.llm import store

CAPACITY = 4_096
END_ID = 1
# Entries the word cache of one worker holds before it starts afresh.
CACHE_WORDS = 250_000

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class SegmentTree:
    """Counts of open bins by remaining capacity; finds the tightest fit in O(log capacity)."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.sums = [0] * (2 * self.size)

    def add(self, at: int, by: int) -> None:
        i = at + self.size
        while i:
            self.sums[i] += by
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """Smallest capacity >= need that has a bin."""
        i = need + self.size
        if self.sums[i]:
            return need
        while i > 1:
            if not i & 1 and self.sums[i + 1]:  # a right sibling holds larger capacities
                i += 1
                while i < self.size:
                    i = 2 * i if self.sums[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first, n, bin, per_bin, offset) of best-fit decreasing.

    ``first`` numbers the pieces of a length from 0; piece ``first + i`` goes
    to bin ``bin + i // per_bin`` at ``offset + (i % per_bin) * length``.
    """
    tree = SegmentTree(capacity)
    open_: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> [(first bin, bins)]
    runs, bins = [], 0

    def put(left: int, first: int, n: int) -> None:
        if n and left:
            open_.setdefault(left, []).append((first, n))
            tree.add(left, n)

    for length in sorted(counts, reverse=True):
        todo, done = counts[length], 0
        while todo:
            left = tree.tightest(length)
            if left is None:  # open as many new bins as the rest needs
                left = capacity
                first, n = bins, -(-todo // (capacity // length))
                bins += n
            else:
                first, n = open_[left].pop()
                tree.add(left, -n)
            per = left // length
            full = min(n, todo // per)
            offset = capacity - left
            if full:
                runs.append((length, done, full * per, first, per, offset))
                put(left - per * length, first, full)
                done, todo = done + full * per, todo - full * per
            if full < n:
                if todo:  # fewer than a bin takes
                    rest = min(todo, per)
                    runs.append((length, done, rest, first + full, per, offset))
                    put(left - rest * length, first + full, 1)
                    done, todo, full = done + rest, todo - rest, full + 1
                put(left, first + full, n - full)
    return runs


# The direct path covers texts of these characters: their normalisation is
# lower case alone, and letters and numbers are the ranges of _PARTS.
_OTHER = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ]")
_PARTS = re.compile("[a-zªµºß-öø-ɏ]+|'(?:s|t|re|ve|m|ll|d)|[0-9²³¹¼-¾]|[^\\sa-zªµºß-öø-ɏ0-9²³¹¼-¾]+")
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_REST = [b for b in range(256) if b not in set(_PLAIN)]
# Byte-level vocabularies write printable bytes as themselves, the rest from U+0100 on.
_BYTES = {b: chr(b) for b in _PLAIN} | {b: chr(256 + i) for i, b in enumerate(_REST)}


class WordTokenizer:
    """Ids of texts by the tokenizer's own vocabulary, each distinct word looked at once.

    The tokenizer lower-cases, splits into runs of letters, single digits and
    runs of other signs, and never joins two of these, so the ids of a text
    are those of its parts in a row. Arrow splits a batch of texts at white
    space and finds its distinct words; their ids come from a bounded memory
    or from the model, and NumPy lays them out in text order. Words with
    characters beyond the direct path, and texts that may hold a special
    token, go to the tokenizer itself.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.limit = limit

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        if len(self.parts) > self.limit:
            self.parts.clear()
        text = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTES)
        ids = [t.id for t in self.model.tokenize(text)]
        self.parts[part] = raw = struct.pack(f"<{len(ids)}I", *ids)
        return raw

    def _word(self, word: str) -> bytes:
        low = word.lower()
        if _OTHER.search(word) or not word.isascii() and _OTHER.search(low):  # one letter's lower case leaves the range
            raw = self._whole(word)
        else:
            known = self.parts
            raw = b"".join([known[p] if p in known else self._part(p) for p in _PARTS.findall(low)])
        if len(self.words) > self.limit:
            self.words.clear()
        self.words[word] = raw
        return raw

    def encode_batch(self, texts: pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text; a null is an empty text."""
        texts = texts.fill_null("")
        special = pc.match_substring(texts, "<|")
        plain = pc.if_else(special, "", pc.ascii_lower(texts))
        lists = pc.ascii_split_whitespace(plain)
        coded = lists.flatten().dictionary_encode()
        known = self.words
        raw = [known[w] if w in known else self._word(w) for w in coded.dictionary.to_pylist()]
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 4
        pool = np.frombuffer(b"".join(raw), dtype="<u4")
        code = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(size[code])]) if len(code) else np.zeros(1, dtype=np.int64)
        shift = (np.cumsum(size) - size)[code] - ends[:-1]
        ids = pool[np.repeat(shift, size[code]) + np.arange(ends[-1])]
        at = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        out = [ids[p:q].tobytes() for p, q in zip(at[:-1].tolist(), at[1:].tolist())]
        for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self._whole(texts[i].as_py())
        return out


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int | None = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32[, ids]."""
    store.python_ready(docs.sparkSession)
    end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = WordTokenizer(tokenizer_path)
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            ids = []
            for doc_id, raw in zip(b.column(0).to_pylist(), tok.encode_batch(b.column(1))):
                raw += end
                for piece, lo in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[lo : lo + 4 * capacity]
                    for c, v in zip(cols, (doc_id, piece, lo // 4, len(part) // 4, zlib.crc32(part))):
                        c.append(v)
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            out = [pa.array(c, t) for c, t in zip(cols, types)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, _PIECE + (", ids array<int>" if with_ids else ""))


def pack(items: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Add sequence_id and offset to ``items`` (a ``length`` column of 1 to ``capacity``).

    ``items`` is read several times, so pass a written table. ``order`` names
    columns that number pieces of equal length; which of them goes where does
    not change how many sequences there are.
    """
    spark: SparkSession = items.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = items.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = store.write_shared(dealt.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n")), "pack-sizes")
    counts = {r[0]: r[1] for r in sizes.groupBy("length").agg(F.sum("_n")).collect()}  # <= capacity rows
    runs = [(n, first, first + k, b, per, off) for n, first, k, b, per, off in plan(counts, capacity)]
    table = store.local_frame(spark, runs, **dict.fromkeys(("length", "_first", "_end", "_bin", "_per", "_off"), pa.int64()))
    # Number of the piece among those of its length: a running total over buckets, then inside a bucket.
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("length", "_b").orderBy(*order)
    numbered = dealt.withColumn("_i", F.row_number().over(inside)).join(sizes, ["length", "_b"])
    numbered = numbered.withColumn("_i", F.col("_base") + F.col("_i") - 1).drop("_base", "_b")
    at = F.col("_i") - F.col("_first")
    # The plan has a few runs per length (its size depends on ``capacity`` alone): a bounded broadcast.
    return (
        numbered.join(
            F.broadcast(table.withColumnRenamed("length", "_len")),
            (F.col("length") == F.col("_len")) & (F.col("_i") >= F.col("_first")) & (F.col("_i") < F.col("_end")),
        )
        .withColumn("sequence_id", F.col("_bin") + F.floor(at / F.col("_per")))
        .withColumn("offset", F.col("_off") + F.pmod(at, F.col("_per")) * F.col("length"))
        .drop("_i", "_len", "_first", "_end", "_bin", "_per", "_off")
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int | None = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Tokenise, cut and pack: the pieces with their sequence_id and offset."""
    cut = store.write_shared(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, with_ids), "pieces")
    return pack(cut, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, n_documents): the token sequences, from pieces packed with their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))  # at most ``capacity`` ids a group
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("p"))
        .select("sequence_id", F.flatten("p.ids").alias("ids"), F.size("p").alias("n_documents"))
    )
