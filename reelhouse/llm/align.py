"""Alignment of two tokenizers over the same text, by token ends in bytes.

A is a byte-level BPE of ``tokenizers``, B a sentencepiece model with a leading
space and byte fallback. Both see space + text. Character offsets (A) and the
spans of the sentencepiece proto (B) say where tokens end; they are coarse
where a character has several bytes, as all its tokens then carry its span. So
a span is only taken where a token ends at the end of a character, and the
tokens inside are placed by their decoded bytes. Places where an A and a B
token both end cut the text into groups; the two tokens ending there are a link.

A text is taken word by word: A's pattern never joins what stands before a
single space with that space, and no entry of B's vocabulary has a space
behind another sign (looked up when the vocabulary is loaded; without it, and
beside other white space, nothing is cut). So the tokens of a text are those of
its words. A worker remembers the words it has aligned, and aligns new ones
many at a time, as one text. When it knows too many it keeps those it has met
again, at most half of what it may know, and learns the others anew.

Links of a document are written with it, once per pair of ids, counted over
the corpus by a combined aggregate (a pair in a third of all links is reduced
in every task) and joined back. The table of pairs is broadcast when it is
found to be small, else it is joined by a shuffle; either way each document
is reduced in its task before anything moves.

Defined results. Texts that are null, empty, or not given back by the bytes of
either tokenizer have no tokens: zeros and ''. A null id is carried, repeated
rows count again, special tokens' strings are plain text. Very long texts are
read whole. Ties: all links at a B id's highest count are best. Extra columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import store

# Words, and letters of words, that a worker remembers before it forgets some.
CACHE_WORDS = 600_000
CACHE_LETTERS = 20_000_000
# Documents looked at together, and letters of new words aligned as one text.
DOCUMENTS = 64
BLOCK_LETTERS = 50_000
# A pair of ids as one number: A's id times this, plus B's.
PAIR = 1 << 31
# A pair table up to this many rows (32 bytes each) is broadcast.
BROADCAST_PAIRS = 2_000_000
_NONE = np.zeros(0, dtype=np.int64)
_PIECE = attrgetter("id", "begin", "end")

# A space that stands alone between other signs, and one beside white space.
_SPACE = re.compile(r"(?<=\S)(?= \S)")
_BESIDE = re.compile(r"\s | \s")


def byte_of_sign() -> dict[str, int]:
    """The byte behind each sign of a byte-level vocabulary: printable Latin-1 stands for
    itself, the other bytes follow in order from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Both tokenizers in one worker, and the words it knows."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        sign = byte_of_sign()
        vocab = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for w, i in vocab.items():
            if all(c in sign for c in w):
                self.a_bytes[i] = bytes(sign[c] for c in w)
        self.b_bytes, plain = [], []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
                continue
            piece = piece.replace("▁", " ")
            self.b_bytes.append(piece.encode())
            if not (self.b.is_control(i) or self.b.is_unknown(i)):  # those never stand for text
                plain.append(piece)
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = (list(map(str, range(len(t)))) for t in (self.a_bytes, self.b_bytes))
        self.words_alone = not any(re.search(r"[^ ] ", p) for p in plain)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}  # word -> its number in the lists below
        self.letters = 0
        self.groups: list[str] = []
        self.told = array("q")  # per word: A tokens (-1: bytes not given back), B tokens, its first pair, its pairs
        self.pairs = array("q")
        self.again = bytearray()  # per word: 1 if it was met after the documents it was learned from

    def thin(self) -> None:
        """Forget the words not met again, and of the others what is more than half of the limits."""
        keep = np.flatnonzero(np.frombuffer(self.again, dtype=np.uint8))[: CACHE_WORDS // 2]
        words = list(self.known)  # in the order of their numbers
        letters = np.cumsum([0, *(len(words[i]) for i in keep.tolist())])
        keep = keep[letters[1:] <= CACHE_LETTERS // 2]
        words, groups = ([of[i] for i in keep.tolist()] for of in (words, self.groups))
        told, pairs = np.frombuffer(self.told, dtype=np.int64).reshape(-1, 4)[keep], np.frombuffer(self.pairs, dtype=np.int64)
        pairs = pairs[self._places(told[:, 2], told[:, 3])]
        told[:, 2] = np.cumsum(told[:, 3]) - told[:, 3]
        self.forget()
        self.known.update(zip(words, range(len(words))))
        self.letters, self.groups, self.again = int(letters[len(keep)]), groups, bytearray(len(words))
        self.told.frombytes(told.tobytes())
        self.pairs.frombytes(pairs.tobytes())

    @staticmethod
    def _places(first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The numbers of runs that begin at ``first`` and are so long, one run after the other."""
        return np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)

    def words(self, text: str) -> list[str]:
        """The words of space + text that start with a space each, which is left out here."""
        if not self.words_alone:
            return [text]
        if text.endswith(" ") or _BESIDE.search(" " + text):  # a space beside white space stays inside
            return [w[1:] for w in _SPACE.split(" " + text)]
        return text.split(" ")

    @staticmethod
    def _ends(size: np.ndarray, coarse: np.ndarray, sure: np.ndarray) -> np.ndarray:
        """Ends in bytes: the coarse ones where they are sure, decoded bytes from there on."""
        by_size = np.cumsum(size)
        last = np.maximum.accumulate(np.where(sure, np.arange(len(size)), -1))
        return by_size + np.where(last >= 0, (coarse - by_size)[last], 0)

    def _encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and ends in bytes of A and B for space + text."""
        whole = " " + text
        letters = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        ends = np.concatenate([[0], np.cumsum(1 + (letters > 0x7F) + (letters > 0x7FF) + (letters > 0xFFFF))])
        found = self.a.encode(whole, add_special_tokens=False)
        a = np.array(found.ids, dtype=np.int64)
        spans = np.fromiter(chain.from_iterable(found.offsets), dtype=np.int64, count=2 * len(a)).reshape(-1, 2)
        # A token whose character the next one starts within or at again ends inside that character.
        sure = np.append(spans[1:, 0], len(whole)) >= spans[:, 1]
        a_end = self._ends(self.a_size[a], ends[spans[:, 1]], sure)
        pieces = self.b.encode(text, return_type="proto").pieces
        b, begin, end = np.fromiter(chain.from_iterable(map(_PIECE, pieces)), dtype=np.int64, count=3 * len(pieces)).reshape(-1, 3).T
        # The added space is in no span. Bytes of a longer character carry an empty span, but for the last.
        b_end = self._ends(self.b_size[b], end + 1, end > begin)
        return a, a_end, b, b_end

    def _given_back(self, ids: list[int], of: list[bytes], ends: list[int], texts: list[bytes]) -> list[bool]:
        """Which texts the bytes of their tokens give back; ``ends``: tokens up to each text's end."""
        parts = list(map(of.__getitem__, ids))
        if b"".join(parts) == b"".join(texts):
            return [True] * len(texts)
        return [b"".join(parts[i:j]) == t for i, j, t in zip([0, *ends], ends, texts)]

    def learn(self, words: list[str]) -> None:
        """Align new words; together they are one text, each behind its space."""
        a, a_end, b, b_end = self._encode(" ".join(words))
        raw = [b" " + w.encode() for w in words]
        last = np.cumsum(list(map(len, raw)))  # where each word ends
        _, at_a, at_b = np.intersect1d(a_end, b_end, assume_unique=True, return_indices=True)
        to = np.searchsorted(a_end[at_a], last, "right")  # groups up to each word's end
        done = (to > 0) & (a_end[at_a[to - 1]] == last) if len(at_a) else np.zeros(len(words), dtype=bool)
        if len(words) > 1 and not done.all():  # no word's tokens reach into another, so this is not met
            for w in words:
                self.learn([w])
            return
        same = [
            x and y and z
            for x, y, z in zip(
                done.tolist(),
                self._given_back(a.tolist(), self.a_bytes, np.searchsorted(a_end, last, "right").tolist(), raw),
                self._given_back(b.tolist(), self.b_bytes, np.searchsorted(b_end, last, "right").tolist(), raw),
            )
        ]
        ids_a, ids_b = (list(map(of.__getitem__, ids.tolist())) for of, ids in ((self.a_text, a), (self.b_text, b)))
        p, q = (at_a + 1).tolist(), (at_b + 1).tolist()
        groups = [
            f"{ids_a[i] if j - i == 1 else ','.join(ids_a[i:j])}|{ids_b[m] if n - m == 1 else ','.join(ids_b[m:n])}"
            for i, j, m, n in zip([0, *p], p, [0, *q], q)
        ]
        n_groups = np.diff(to, prepend=0)
        n_a, n_b = (np.diff(np.append(0, np.append(0, at + 1)[to]), prepend=0)[1:] for at in (at_a, at_b))
        first = len(self.pairs) + to - n_groups
        self.told.frombytes(np.stack([np.where(same, n_a, -1), n_b, first, n_groups], axis=1).astype(np.int64).tobytes())
        self.pairs.frombytes((a[at_a] * PAIR + b[at_b]).astype(np.int64).tobytes())
        self.known.update(zip(words, range(len(self.groups), len(self.groups) + len(words))))
        self.letters += sum(map(len, words))
        self.again.extend(bytes(len(words)))
        ends = to.tolist()
        self.groups.extend([";".join(groups[i:j]) for i, j in zip([0, *ends], ends)])

    def documents(self, texts: list[str | None]) -> list[tuple]:
        """Per text: (A tokens, B tokens, groups, their SHA-256, linked pairs, how often each is linked)."""
        if len(self.known) > CACHE_WORDS or self.letters > CACHE_LETTERS:
            self.thin()
        before = len(self.known)
        split = [self.words(t) if t else [] for t in texts]
        block, size = [], 0
        for word in set().union(*split).difference(self.known):
            block.append(word)
            size += len(word)
            if size > BLOCK_LETTERS:
                self.learn(block)
                block, size = [], 0
        if block:
            self.learn(block)
        # Views of the lists, given up before the next words come.
        told, pairs = np.frombuffer(self.told, dtype=np.int64).reshape(-1, 4), np.frombuffer(self.pairs, dtype=np.int64)
        again = np.frombuffer(self.again, dtype=np.uint8)
        return [self._document(list(map(self.known.__getitem__, w)), before, told, pairs, again) for w in split]

    def _document(self, numbers: list[int], before: int, told: np.ndarray, pairs: np.ndarray, again: np.ndarray) -> tuple:
        at, times = np.unique(np.array(numbers, dtype=np.int64), return_counts=True)
        again[at[at < before]] = 1
        known = told[at]
        if not numbers or (known[:, 0] < 0).any():
            return 0, 0, 0, "", _NONE, _NONE
        size = known[:, 3]
        linked, inverse = np.unique(pairs[self._places(known[:, 2], size)], return_inverse=True)
        n = np.bincount(inverse, weights=np.repeat(times, size), minlength=len(linked)).astype(np.int64)
        line = ";".join(map(self.groups.__getitem__, numbers))
        n_a, n_b = (times @ known[:, :2]).tolist()
        return n_a, n_b, int(n.sum()), hashlib.sha256(line.encode()).hexdigest(), linked, n


# One per pair of tokenizer files in a worker, so that its tasks share what it remembers.
_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


_ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>"


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, digest of the groups, linked pairs of ids and how often each is linked."""
    store.python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for b in batches:
            texts = b.column(2).to_pylist()
            rows = [r for i in range(0, len(texts), DOCUMENTS) for r in both.documents(texts[i : i + DOCUMENTS])]
            offsets = pa.array(np.cumsum([0, *(len(r[4]) for r in rows)]).astype(np.int32))
            pairs, times = (np.concatenate([_NONE, *(r[k] for r in rows)]) for k in (4, 5))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1)]
                + [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
                + [pa.array([r[3] for r in rows], pa.string())]
                + [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (pairs, times)],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    return rows.mapInArrow(run, _ALIGNED)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best): links of each pair in the corpus, and whether no pair of its B id has more."""
    counts = links.groupBy("pair").agg(F.sum("times").alias("n"))
    counts = store.write_shared(counts.withColumn("b", F.col("pair").bitwiseAND(PAIR - 1)), "align-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row."""
    told = store.write_shared(aligned(docs, path_a, path_b, id_col, text_col), "align-documents")
    links = told.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l"))
    links = links.select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    counts = store.write_shared(pair_counts(links), "align-pairs")
    if counts.count() <= broadcast_pairs:
        counts = F.broadcast(counts)
    sums = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")
    )
    none = F.lit(0).cast("long")
    return told.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )
