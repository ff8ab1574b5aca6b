"""Secret scans: a linear-chain conditional random field over tokens, decoded by Viterbi.

Tokens are runs of signs without white space, quotes, brackets and ``:;,=``.
The field tags each as secret begin (B), inside (I) or outside (O) from its
shape (character classes, length, variety of signs), the shapes of the
neighbouring tokens, whether a word such as ``token`` or ``password`` stands
shortly before it, and features of the whole text (its length, whether such a
word occurs at all). Weights come from maximum conditional likelihood, with
the spans of the base patterns as labels, on a bounded sample: the
``SAMPLE_DOCS`` documents with the smallest id hashes.

One structural zero keeps decoding exact and cheap: a plain word (letters
only, all lower-case or capitalised, fewer than ``LONG`` signs, with or without
signs of ``_EDGE`` around it) and a bare sign are always O; every other token
is open, also one without a digit (mixed case, mixed signs). Tokens next to
such a token have no link across it, so the best path of the text is the best
path of each run of other tokens, and only those are decoded.

The base patterns (assign, access, hex) are always reported; the field adds
runs that overlap none of them, as kind ``crf``. Spans are code points of the
whole text, end exclusive.

Nulls: a null text is empty; a null id is carried. A sample without any secret
gives a field that adds nothing. Very long texts are scanned whole. Ties: of
equally good tags the first of B, I, O wins. Repeated rows are reported each. Extra
columns are ignored. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import store

# The sample the field is fitted on: documents, and runs of tokens from them.
SAMPLE_DOCS = 20_000
SAMPLE_RUNS = 20_000
PIECE = 16
LONG = 20
NEAR_CHARS = 40
RIDGE = 0.05
STEPS = 300
KINDS = ("assign", "access", "hex", "crf")

# Base patterns.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run of fewer can't pass, and a run is matched whole
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_NAMES = re.compile("passw|secret|token|api_?key|credential|private|auth", re.I | re.A)

_SIGN = r"[^\s\"'`=:;,(){}\[\]<>]"
_TOKEN = re.compile(rf"{_SIGN}+|[\"'`=:;,(){{}}\[\]<>]")
_EDGE = ".!?#*%$&|~^"
# Tokens the field may tag: all but plain words; ``plain`` has the last word on other alphabets.
_OPEN = re.compile(
    rf"(?<!{_SIGN})(?![{re.escape(_EDGE)}]*+(?:[^\W\d_][a-z\xdf-\xf6\xf8-\xff]{{0,{LONG - 2}}}+)?[{re.escape(_EDGE)}]*+(?!{_SIGN})){_SIGN}+"
)

B, I, O = 0, 1, 2
# Shapes: character class x length step x variety of signs; then words and single signs.
_CLASSES = ("digits", "number", "lowhex", "uphex", "lowalnum", "upalnum", "mixed", "mixedsigns", "at", "letters", "other", "mixedcase", "lettersigns")
_STEPS = (4, 8, 12, 16, 20, 24, 32, 48)
_WORD, _NAME, _END = (len(_CLASSES) * (len(_STEPS) + 1) * 2 + i for i in range(3))
_SIGNS = {c: _END + 1 + i for i, c in enumerate("=:\"'`;,(){}[]<>")}
N_SHAPES = _END + 1 + len(_SIGNS)
N_FILE = 4


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _secret_parts(text: str) -> list[tuple[int, int]]:
    """What the labels call secret: values of assignments, keys and hex runs."""
    low = text.lower()
    out = [(m.start(), m.end()) for m in _HEX.finditer(text)]
    if any(k in low for k in _KEYWORDS):
        out += [m.span(2) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [m.span() for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out


def plain(token: str) -> bool:
    """A bare sign or a short word in lower case or capitalised: always outside."""
    t = token.strip(_EDGE)
    return not t or t.isalpha() and len(t) < LONG and t[1:] == t[1:].lower()


def shape(token: str, own: bool = False) -> int:
    """Shape number of a token; ``own``: of one that is tagged, where names of secrets are signs too."""
    if token in _SIGNS:
        return _SIGNS[token]
    t = token.strip(_EDGE)
    if t.isalpha() and len(t) < LONG and not own or not t:
        return _NAME if t and _NAMES.search(t) else _WORD
    low, up = t != t.upper(), t != t.lower()
    digit = any(c.isdigit() for c in t)
    if t.isdigit():
        kind = 0
    elif "@" in t:
        kind = 8
    elif digit and not low and not up:
        kind = 1
    elif t.isalpha():
        kind = 9 if t[1:] == t[1:].lower() else 11
    elif t.isalnum() and t.isascii():
        hexa = all(c in "0123456789abcdefABCDEF" for c in t)
        kind = 6 if low and up else (2 if low else 3) if hexa else 4 if low else 5
    elif digit and all(c.isascii() and (c.isalnum() or c in "+/_-.") for c in t):
        kind = 7
    elif not digit and all(c.isalpha() or c in "+/_-.!?#*%$&|~^\\" for c in t):
        kind = 12
    else:
        kind = 10
    step = sum(len(t) >= s for s in _STEPS)
    varied = len(set(t)) * 3 >= min(len(t), 24)
    return (kind * (len(_STEPS) + 1) + step) * 2 + varied


def file_features(text: str) -> int:
    """Feature of the whole text: names of secrets anywhere, length."""
    low = text.lower()
    return 2 * any(k in low for k in _KEYWORDS) + (len(text) > 2_000)


def _before(text: str, start: int) -> tuple[str, int]:
    """The token before ``start`` ('' at the text's start) and where it starts."""
    end = start
    while end and text[end - 1].isspace():
        end -= 1
    if not end:
        return "", 0
    at = end - 1
    if text[at] in _SIGNS:
        return text[at], at
    while at and not text[at - 1].isspace() and text[at - 1] not in _SIGNS:
        at -= 1
    return text[at:end], at


def runs(text: str) -> Iterator[tuple[list[tuple[int, int]], np.ndarray]]:
    """Runs of open tokens: spans (without edge signs) and features per token.

    Features: own shape, shape before, shape after, a name of a secret within
    NEAR_CHARS before, file feature.
    """
    spans: list[tuple[int, int]] = []
    feats: list[list[int]] = []
    file = -1
    last_end = -1
    for m in _OPEN.finditer(text):
        if plain(m[0]):
            continue
        own = shape(m[0], own=True)
        if file < 0:
            file = file_features(text)
        if spans and not text[last_end : m.start()].isspace():
            yield spans, np.array(feats)
            spans, feats = [], []
        before, _ = _before(text, m.start())
        after = _TOKEN.search(text, m.end())
        near = _NAMES.search(text, max(0, m.start() - NEAR_CHARS), m.start())
        lead = len(m[0]) - len(m[0].lstrip(_EDGE))
        spans.append((m.start() + lead, m.start() + len(m[0].rstrip(_EDGE))))
        feats.append([own, shape(before) if before else _END, shape(after[0]) if after else _END, int(near is not None), file])
        last_end = m.end()
    if spans:
        yield spans, np.array(feats)


def _expand_table() -> tuple[np.ndarray, np.ndarray]:
    """Per shape number: its class, and the numbers of its length and variety features."""
    per = (len(_STEPS) + 1) * 2
    cls, rest = np.zeros(N_SHAPES, dtype=np.int64), np.zeros((N_SHAPES, len(_STEPS) + 1), dtype=np.int64)
    for n in range(N_SHAPES):
        cls[n] = n // per if n < _WORD else len(_CLASSES) + n - _WORD
        step, varied = divmod(n % per, 2) if n < _WORD else (0, 0)
        # One feature per length that the token reaches or not, so lengths between known ones are known too.
        rest[n] = [2 * i + (step > i) for i in range(len(_STEPS))] + [2 * len(_STEPS) + varied]
    return cls, rest


_CLASS_OF, _SIZE_OF = _expand_table()
N_CLASSES = int(_CLASS_OF.max()) + 1


class Field:
    """Potentials of the linear-chain field: states B, I, O."""

    # Own class, length and variety; classes before and after; name nearby; file.
    SIZES = (N_CLASSES, *[2 * (len(_STEPS) + 1)] * (len(_STEPS) + 1), N_CLASSES, N_CLASSES, 2, N_FILE)

    def __init__(self, weights: np.ndarray | None = None):
        starts, at = [], 0
        for i, n in enumerate(self.SIZES):
            starts.append(at)
            at += 0 if 1 <= i < len(_STEPS) + 1 else n  # the size features share one range
        self.offsets = np.array(starts)
        self.weights = np.zeros((at + 4, 3)) if weights is None else weights

    def numbers(self, feats: np.ndarray) -> np.ndarray:
        """Feature numbers of tokens given as (shape, shape before, shape after, near, file)."""
        own, before, after, near, file = np.moveaxis(feats, -1, 0)
        parts = [_CLASS_OF[own][..., None], _SIZE_OF[own], *[x[..., None] for x in (_CLASS_OF[before], _CLASS_OF[after], near, file)]]
        return np.concatenate(parts, axis=-1) + self.offsets

    @property
    def links(self) -> np.ndarray:
        """Transition potentials; O to I is impossible."""
        t = self.weights[-4:-1].copy()
        t[O, I] = -1e9
        return t

    @property
    def first(self) -> np.ndarray:
        """Potentials of the first token of a run, which follows an O."""
        return self.links[O]

    def emit(self, feats: np.ndarray) -> np.ndarray:
        return self.weights[self.numbers(feats)].sum(axis=-2)

    def viterbi(self, feats: np.ndarray) -> list[int]:
        e, links = self.emit(feats), self.links
        score, back = self.first + e[0], []
        for row in e[1:]:
            step = score[:, None] + links
            back.append(step.argmax(axis=0))
            score = step.max(axis=0) + row
        path = [int(score.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]

    def secrets(self, text: str) -> list[tuple[int, int]]:
        """Spans of the runs tagged B I* on the best path."""
        out: list[tuple[int, int]] = []
        for spans, feats in runs(text):
            for (p, q), tag in zip(spans, self.viterbi(feats)):
                if tag == B:
                    out.append((p, q))
                elif tag == I:
                    out[-1] = (out[-1][0], q)
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(examples: list[tuple[np.ndarray, np.ndarray, float]], steps: int = STEPS, ridge: float = RIDGE) -> Field:
    """Maximum conditional likelihood from (features, tags, weight) runs.

    Gradients come from forward and backward sums, steps are Adam's. Each run
    with a secret is also seen without its context (no name nearby, plain
    words around), so that shape alone can tell.
    """
    field = Field()
    examples = list(examples)
    for f, y, weight in examples[:]:
        if (y != O).any():
            bare = f.copy()
            bare[0, 1], bare[-1, 2], bare[:, 3], bare[:, 4] = _WORD, _WORD, 0, bare[:, 4] % 2
            examples.append((bare, y, weight))
    if not any((y != O).any() for _, y, _ in examples):
        field.weights[: field.offsets[1], O] = 1.0  # nothing to learn from: everything is outside
        return field
    groups: dict[int, tuple[list, list, list]] = {}  # by length, so that each is one array
    for f, y, weight in examples:
        for to, x in zip(groups.setdefault(len(y), ([], [], [])), (f, y, weight)):
            to.append(x)
    # Tokens with equal features are summed up before their weights are touched.
    kinds, of = np.unique(np.concatenate([np.concatenate(f) for f, _, _ in groups.values()]), axis=0, return_inverse=True)
    numbers, of, data, at = field.numbers(kinds), of.ravel(), [], 0
    for length, (f, y, v) in groups.items():
        data.append((of[at : at + len(f) * length].reshape(len(f), length), np.stack(y), np.array(v)))
        at += len(f) * length
    total = sum(float(v.sum()) for _, _, v in data)
    w = field.weights
    mean, var = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        grad = -ridge * w / total
        emitted, gains = field.weights[numbers].sum(axis=-2), np.zeros((len(kinds), 3))
        links = field.links
        for f, y, v in data:
            e = emitted[f]
            n, length = y.shape
            fwd = [field.first + e[:, 0]]
            for i in range(1, length):
                fwd.append(_log_sum(fwd[-1][:, :, None] + links, 1) + e[:, i])
            bwd = [np.zeros((n, 3))]
            for i in range(length - 1, 0, -1):
                bwd.append(_log_sum(links + (e[:, i] + bwd[-1])[:, None, :], 2))
            bwd = bwd[::-1]
            z = _log_sum(fwd[-1], 1)[:, None]
            gain = v[:, None, None] * (np.eye(3)[y] - np.exp(np.stack(fwd, 1) + np.stack(bwd, 1) - z[:, None]))
            for s in range(3):
                gains[:, s] += np.bincount(f.ravel(), gain[:, :, s].ravel(), len(kinds))
            grad[-2] += gain[:, 0].sum(axis=0) / total  # the link from O to the first token
            for i in range(1, length):
                pair = np.exp(fwd[i - 1][:, :, None] + links + (e[:, i] + bwd[i])[:, None, :] - z[:, :, None])
                seen = np.bincount(3 * y[:, i - 1] + y[:, i], v, 9).reshape(3, 3)
                grad[-4:-1] += (seen - (v[:, None, None] * pair).sum(axis=0)) / total
        for k in range(numbers.shape[-1]):
            np.add.at(grad, numbers[:, k], gains / total)
        mean = 0.9 * mean + 0.1 * grad
        var = 0.99 * var + 0.01 * grad**2
        field.weights = w = w + 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.99**step)) + 1e-8)
    return field


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_runs: int = SAMPLE_RUNS) -> Field:
    """Fit the field on the documents (doc_id, text) with the smallest id hashes."""
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    ids = store.write_shared(ids.select(F.col("doc_id").alias("_id")), "crf-ids")
    # At most ``sample_docs`` ids of 8 bytes.
    sample = docs.join(F.broadcast(ids), docs["doc_id"] == ids["_id"]).select("text")

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            feats, tags = [], []
            for text in b.column(0).to_pylist():
                parts = _secret_parts(text or "")
                for spans, f in runs(text or ""):
                    y = []
                    for p, q in spans:
                        hit = next((s for s in parts if s[0] < q and p < s[1]), None)
                        y.append(O if hit is None else I if y and y[-1] != O and hit[0] < p else B)
                    # What follows an O starts like a run, so a long run is learnt in pieces.
                    lo = 0
                    for hi in range(1, len(y) + 1):
                        if hi == len(y) or hi - lo >= PIECE and y[hi - 1] == O:
                            feats.append(f[lo:hi].ravel())
                            tags.append(y[lo:hi])
                            lo = hi
            yield pa.RecordBatch.from_arrays(
                [pa.array(feats, pa.list_(pa.int32())), pa.array(tags, pa.list_(pa.int32()))], names=["f", "y"]
            )

    found = sample.mapInArrow(observe, "f array<int>, y array<int>").groupBy("f", "y").count()
    rows = found.orderBy(F.xxhash64("f", "y"), "f", "y").limit(sample_runs).collect()  # bounded by ``sample_runs``
    return fit([(np.array(r["f"]).reshape(-1, 5), np.array(r["y"]), 1 + np.log(r["count"])) for r in rows])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """Per row: doc_id, spans array<start, kind number, end> by start, then kind as in KINDS."""
    spark = docs.sparkSession
    store.python_ready(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast((field or train(rows)).weights)  # a fixed number of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Field(shared.value)
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                # Union of the base spans as flat, sorted edges: a span is free of them
                # when both its ends fall into the same gap.
                edges: list[int] = []
                for p, _, q in base:
                    if edges and p <= edges[-1]:
                        edges[-1] = max(edges[-1], q)
                    else:
                        edges += [p, q]
                added = [
                    (p, 3, q) for p, q in tagger.secrets(text)
                    if (i := bisect_right(edges, p)) % 2 == 0 and i == bisect_left(edges, q)
                ]
                out.append([{"start": p, "kind": k, "end": q} for p, k, q in sorted(base + added)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, kind)], names=["doc_id", "spans"])

    return rows.mapInArrow(run, "doc_id long, spans array<struct<start: bigint, kind: int, end: bigint>>")


def span_list(base_only: bool):
    """kind:start:end, comma-joined."""
    chosen = F.filter("spans", lambda s: s["kind"] < 3) if base_only else F.col("spans")
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(chosen, one), ",")
