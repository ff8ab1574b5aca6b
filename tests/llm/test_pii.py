import random
import re

import pytest

from llm.conftest import rows
from reelhouse.llm import pii


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base(t):
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


def found(docs, texts):
    got = rows(pii.find_pii(docs(texts)))
    return [[(s.start, s.rank, s.end, s.kind) for s in got[i].spans if s.rank < 4] for i in range(len(texts))]


HARD = [
    None, "", "x.y@a.b.c_d@e.f", "a@b.c.@x.y a@b a@@b.c @b.c a@.b é@é.é", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.000255 1..2.3.4 .1.2.3.4",
    "4785380592391139 4785380592391139", "4785-3805 9239-1139", "4785  380592391139 5-5-5", "4" * 14, "0" * 16, "00000000000000-1",
    "+1 (212) 555-1234 152.143.123.131", "+12345 +1--------------2 +1 2 3 4 5 6 7 8 9 0.", "++1234567890 +١23", "1" * 3_000 + ".1.1.1", "é" * 50 + " q@r.st " + "😀" * 9 + "1.1.1.1",
]


def test_base_spans_equal_the_plain_patterns(docs):
    rnd = random.Random(2)
    signs = "ab1234590..@@+-  ()_%é\n"
    texts = HARD + ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60))) for _ in range(1_500)]
    texts += ["".join(rnd.choice("0123456789 -") for _ in range(rnd.randint(10, 60))) for _ in range(500)]
    assert found(docs, texts) == [base(t or "") for t in texts]


def test_many_matches_and_long_runs(docs):
    texts = [" ".join(f"10.0.{i % 256}.{i % 200}" for i in range(3_000)), "7" * 200_000, "a" * 300_000 + "@b.cd", "a." * 100_000, "1 " * 100_000, "+1" * 50_000]
    got = found(docs, texts)
    assert got[0] == base(texts[0]) and got[2] == [(0, 0, 300_005, "email")]
    assert got[1] == got[3] == got[4] == got[5] == []


def test_added_kinds_need_checksum_or_context(docs):
    texts = [
        "IBAN GB82 WEST 1234 5698 7654 32 end", "GB82WEST12345698765433", "SSN 123-45-6789", "part 123-45-6789 of", "x" * 60 + " 123-45-6789 " + "y" * 60 + " ssn",
    ]
    got = rows(pii.find_pii(docs(texts)))
    kinds = [[(s.kind, s.start, s.end) for s in got[i].spans] for i in range(len(texts))]
    assert kinds == [[("iban", 5, 32)], [], [("ssn", 4, 15)], [], []]
    assert got[0].spans[0].score == pytest.approx(0.9)


def test_iban_ends_at_its_countrys_length(docs):
    iban, other = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    texts = [f"pay {iban}{rest}" for rest in (" Thanks", " BIC COBADEFF", " 2024", f" {other} OK", ".", "")]
    got = rows(pii.find_pii(docs(texts + [f"pay {iban}0 Thanks", f"X{iban}"])))
    spans = [[(s.start, s.end) for s in got[i].spans if s.kind == "iban"] for i in range(8)]
    assert spans == [[(4, 31)]] * 3 + [[(4, 31), (32, 54)]] + [[(4, 31)]] * 2 + [[], []]


def test_empty_and_native(docs):
    out = pii.find_pii(docs([]))
    assert out.count() == 0 and "Python" not in out._jdf.queryExecution().executedPlan().toString()
