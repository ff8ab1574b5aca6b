"""PII (native): regular expressions propose, checksums confirm, context words adjust the score.

Base kinds are email, ip, card (Luhn) and phone; the method adds iban (mod 97;
its length is that of its country, so it ends where it ends whatever follows)
and ssn (only near a word that names it). A proposal of a base kind that its
validator confirms is always a span; an added kind needs a score of
``LEAST_SCORE``, which is the kind's own score plus ``CONTEXT_GAIN`` when one
of its context words is among the ``CONTEXT_CHARS`` characters on either side.

Matches are leftmost and non-overlapping per kind; a failing match is dropped
without retries. The patterns equal the contract's on every text but start a
match only where a run starts (or the last match ended) and never give
characters back, so they are linear on long runs and do not recurse. Spans are
code points of the whole text, end exclusive: the texts between matches come
from ``split`` with the same pattern, and positions are running sums of the
lengths, taken in blocks so that a text with very many matches stays linear
enough.

Nulls: a null text is empty; a null id is carried. Repeated rows are reported
each. Extra columns are ignored. Empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import store

CONTEXT_CHARS = 40
CONTEXT_GAIN = 0.3
LEAST_SCORE = 0.5
_BLOCK = 256  # matches whose positions are summed at a time

# Countries by the length of their IBAN (ISO 13616 registry and the partial adopters).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_BODIES = "|".join(
    rf"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])" for n, codes in IBAN_LENGTHS.items()
)

_L = "[A-Za-z0-9._%+-]"
_D = "[A-Za-z0-9-]"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str  # Java regular expression
    cheap: str | None  # a string that every match contains, looked for first
    base: bool
    score: float
    context: str  # words, as a regular expression over lower-cased text


KINDS = (
    Kind("email", rf"{_L}(?:(?<!{_L}{_L})|(?<=\G{_L})){_L}*+@{_D}++(?:\.{_D}++)++", "@", True, 0.8, "mail|contact|write to"),
    Kind("ip", r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++", ".", True, 0.6, r"\bip\b|address|host|server"),
    # A whole run of digits with single separators; runs of fewer than 14 digits can't pass.
    Kind("card", r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){13,}+", None, True, 0.7, "card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", True, 0.6, "phone|call|tel|mobile|fax"),
    Kind("iban", rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_BODIES})", None, False, 0.6, "iban|account|bank"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", False, 0.3, r"\bssn\b|social security"),
)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Luhn check of the digits in ``m``."""
    number = F.split(F.reverse(_digits(m)), "")
    value = lambda d, i: d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
    add = F.transform(F.filter(number, lambda d: d != ""), lambda d, i: F.when(value(d, i) > 9, value(d, i) - 9).otherwise(value(d, i)))
    return F.aggregate(add, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def mod97(m: Column) -> Column:
    """ISO 7064 mod 97 check of an IBAN, spaces ignored."""
    plain = F.replace(m, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    signs = F.filter(F.split(turned, ""), lambda c: c != "")
    step = lambda acc, c: F.when(
        c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97
    ).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(signs, F.lit(0), step) == 1


def _octets(m: Column) -> Column:
    short = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(F.split(m, r"\."), lambda p: (F.length(short(p)) <= 3) & (F.substr(short(p), F.lit(1), F.lit(3)).cast("int") <= 255))


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    return {
        "ip": lambda: _octets(m),
        "card": lambda: F.when(n.between(14, 19), luhn(m)).otherwise(False),
        "phone": lambda: n.between(10, 15),
        "iban": lambda: mod97(m),
    }.get(kind, lambda: F.lit(True))()


_SPAN = "array<struct<start: bigint, rank: int, end: bigint, kind: string, score: double>>"


def _starts(lengths: Column) -> Column:
    """Running sums before each element, block by block."""
    add = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def block(b: Column) -> Column:
        part = F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))
        base = add(F.slice(lengths, F.lit(1), b * _BLOCK))
        return F.transform(part, lambda _, i: base + add(F.slice(part, F.lit(1), i)))

    blocks = F.ceil(F.size(lengths) / F.lit(float(_BLOCK))).cast("int")
    return F.flatten(F.transform(F.sequence(F.lit(0), blocks - 1), block))


def _spans(rank: int, kind: Kind, matches: Column, gaps: Column) -> Column:
    """Confirmed spans from the matches and the texts between them."""
    # Gap and match before match i, and gap i: starts of matches are sums of both.
    lengths = F.transform(matches, lambda m, i: (F.length(F.get(gaps, i)) + F.when(i > 0, F.length(F.get(matches, i - 1))).otherwise(0)).cast("long"))
    found = F.transform(
        F.arrays_zip(matches.alias("m"), _starts(lengths).alias("s"), lengths.alias("l")),
        lambda x, i: F.struct((x["s"] + x["l"]).alias("start"), x["m"].alias("m"), i.alias("i")),
    )
    near = lambda i: F.lower(F.concat_ws("\n", F.right(F.get(gaps, i), F.lit(CONTEXT_CHARS)), F.left(F.get(gaps, i + 1), F.lit(CONTEXT_CHARS))))
    scored = F.transform(
        F.filter(found, lambda x: _valid(kind.name, x["m"])),
        lambda x: F.struct(
            x["start"].cast("long").alias("start"),
            F.lit(rank).alias("rank"),
            (x["start"] + F.length(x["m"])).cast("long").alias("end"),
            F.lit(kind.name).alias("kind"),
            (kind.score + F.when(near(x["i"]).rlike(kind.context), CONTEXT_GAIN).otherwise(0.0)).alias("score"),
        ),
    )
    return scored if kind.base else F.filter(scored, lambda s: s["score"] >= LEAST_SCORE)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Per row: doc_id, spans array<start, rank, end, kind, score>, by start, then kind as listed."""
    rows = docs.select(F.col(id_col).alias("doc_id"), store.text_or_empty(text_col).alias("text"))
    none = F.array().cast("array<string>")

    def proposals(k: Kind) -> Column:
        found = F.regexp_extract_all("text", F.lit(k.pattern), 0)
        return F.when(F.col("text").contains(k.cheap), found).otherwise(none) if k.cheap else found

    rows = rows.select("*", *[proposals(k).alias(f"m_{k.name}") for k in kinds])
    rows = rows.select(
        "*",
        *[F.when(F.size(f"m_{k.name}") > 0, F.split("text", k.pattern, -1)).otherwise(none).alias(f"g_{k.name}") for k in kinds],
    )
    each = [
        F.when(F.size(f"m_{k.name}") > 0, _spans(i, k, F.col(f"m_{k.name}"), F.col(f"g_{k.name}")).cast(_SPAN))
        .otherwise(F.array().cast(_SPAN))
        for i, k in enumerate(kinds)
    ]
    return rows.select("doc_id", F.sort_array(F.concat(*each)).alias("spans"))


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def span_list(base_only: bool, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """kind:start:end, comma-joined."""
    n_base = sum(k.base for k in kinds)
    chosen = F.filter("spans", lambda s: s["rank"] < n_base) if base_only else F.col("spans")
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(chosen, one), ",")
