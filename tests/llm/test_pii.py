"""Personal data: strict spans against plain regular expressions, and what the trees add."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from marketlake.llm import pii
from marketlake.llm.catalog import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import rows_of

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_base(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                    "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]():
                out.append((m.start(), k, m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in spans)


@pytest.mark.parametrize("which", ["small", "odd", "empty"])
def test_query_matches_brute_force(spark, odd, empty, which):
    root = {"small": SF_SMALL, "odd": odd, "empty": empty}[which]
    docs = rows_of(spark.read.parquet(f"{root}/documents.parquet"), "doc_id", "text")
    got = QUERIES["op12_personal_data"](spark, root)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    want = []
    for d, t in docs:
        b = brute_base(t)
        want.append((d, *[sum(k == i for _, k, _ in b) for i in range(4)], hashlib.sha256(joined(b).encode()).hexdigest()))
    rows = rows_of(got, *got.columns)
    assert sorted(map(str, (r[:-1] for r in rows))) == sorted(map(str, want))
    assert which != "small" or sum(map(sum, (w[1:5] for w in want))) > 5
    by_digest = {w[-1]: joined(brute_base(t)) for w, (_, t) in zip(want, docs)}
    for r in rows:                                                     # strict spans stay
        assert set(filter(None, by_digest[r[5]].split(","))) <= set(r[6].split(","))


def test_strict_spans_of_odd_texts(spark):
    rnd = random.Random(4)
    alphabet = ["a", "b1", "@", ".", "..", "-", "_", "+", "%", " ", "  ", "(", ")", "é", "\U0001f642", "\n", "0", "255", "256",
                "1.2.3.4", "a@b.c", "d@e.f.g_h@i.j", "+1 (234) 567-8901", "4539 1488 0343 6467", "00000000000000", " 7"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += [None, "", "x" * 3000, "1" * 3000, "a@" * 3000, "a@b" + ".c" * 3000, "1." * 3000, "+1 " * 3000,
              "7 " * 3000, "+1" + " " * 3000, "\U0001f642" * 1000 + "q@r.st " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(8)
    got = rows_of(df.select("i", pii.base_spans(F.coalesce("t", F.lit(""))).alias("b")), "i", "b")
    assert len(got) == len(texts)
    for i, spans in got:
        assert [tuple(s) for s in spans] == brute_base(texts[i]), texts[i][:80] if texts[i] else None


def test_long_texts_take_linear_time(spark):
    """Long runs of one character class each; a plain pattern would take their square."""
    n = 8_000
    texts = ["x" * n, "1" * n, "a@" * n, "a@b" + ".c" * n, "+1" + " " * n + "2", "7 " * n, "1." * n, "q@r.st " * (n // 10)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(8)
    got = df.select("i", F.size(pii.base_spans(F.col("t"))).alias("b"), F.size(
        pii.let(F.struct("t", pii.base_spans(F.col("t")).alias("b")), lambda s: pii.candidates(s["t"], s["b"]))).alias("c"))
    counts = {i: b for i, b, _ in rows_of(got, "i", "b", "c")}
    assert [counts[i] for i in range(8)] == [0, 0, 0, 1, 0, 0, n // 4, n // 10]


def lookalikes(n):
    """Texts with card numbers and phones, most of them strict, and numbers that are neither."""
    rnd = random.Random(2)
    rows = []
    for i in range(n):
        body = "".join(rnd.choice("0123456789") for _ in range(14))
        card = next(f"4{body}{c}" for c in "0123456789" if luhn(f"4{body}{c}"))
        if i % 40 == 0:
            card = card[:-1] + str((int(card[-1]) + 3) % 10)           # mistyped
        phone = f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"
        if i % 40 == 1:
            phone = phone[3:]                                          # without its country code
        order = "".join(rnd.choice("123456789") for _ in range(12))
        rows.append((i, f"Pay with card {card} or call {phone} today." if i % 2 else f"order {order} was of {i} parts"
                     if i % 3 else f"my card {card} is here"))
    return rows


def test_trees_add_what_looks_and_stands_like_strict_spans(spark):
    rows = lookalikes(3000)
    texts = dict(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = pii.personal_data(df).collect()
    added = {(r.doc_id, texts[r.doc_id][s.start:s.end]) for r in found for s in r.spans if s.score < 1}
    mistyped = [i for i, t in rows if i % 40 == 0 and "card" in t]
    assert mistyped and {i for i, t in added if len(t) == 16} == set(mistyped)
    assert not any(texts[i].startswith("order") for i, _ in added)
    again = pii.personal_data(df.repartition(7)).collect()
    key = lambda rows: sorted(str(r.asDict()) for r in rows)
    assert key(found) == key(again)


def test_thresholds():
    assert pii._threshold([(199, 100, 100), (10, 50, 0)]) == (199 + 10) / 2 / 200
    assert pii._threshold([(199, 1000, 1000), (60, 3, 2), (5, 10, 0)]) == 0.6475          # under a half: left out
    assert pii._threshold([(199, 1000, 1000), (150, 10, 0), (120, 90, 0)]) == 0.675       # 95 % ends there
    assert pii._threshold([(199, 1000, 1000)]) == 0.5 and pii._threshold([(199, 10, 10)]) is None and pii._threshold([]) is None


def test_running_sums_over_blocks(spark):
    values = [i % 7 for i in range(1000)]
    for n in (1, 63, 64, 65, 1000):
        df = spark.createDataFrame([(values[:n],)], "v array<int>")
        (out,), = rows_of(df.select(pii.running_sum(F.col("v")).alias("s")), "s")
        assert out == [sum(values[:i + 1]) for i in range(n)]


def test_no_python_on_the_main_path(spark):
    found = pii.find_candidates(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    for df in (found, QUERIES["op12_personal_data"](spark, SF_SMALL)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
