"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from marketlake.llm import periodic
from marketlake.llm.catalog import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import rows_of

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(x, least=12):
    out = []
    for q in range(1, len(x) // 2 + 1):
        start = 0
        for i in range(len(x) - q + 1):
            if i == len(x) - q or x[i] != x[i + q]:
                n = i - start + q
                part = x[start:start + n]
                if n >= max(least, 2 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.append((start, n, q))
                start = i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    words = WORDS.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    runs = brute_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("which", ["small", "odd", "empty"])
def test_query_matches_brute_force(spark, odd, empty, which):
    root = {"small": SF_SMALL, "odd": odd, "empty": empty}[which]
    docs = rows_of(spark.read.parquet(f"{root}/documents.parquet"), "doc_id", "text")
    short = {(d, t) for d, t in docs if len(WORDS.findall(t or "")) < 700}
    got = QUERIES["op11_periodic_runs"](spark, root)
    assert got.columns == COLUMNS
    rows = rows_of(got, *COLUMNS)
    assert len(rows) == len(docs)
    want = {expected(d, t) for d, t in short}
    ids = {d for d, _ in docs} - {d for d, t in docs if (d, t) not in short}
    assert {r for r in rows if r[0] in ids} == {w for w in want if w[0] in ids}
    assert which == "empty" or any(r[1] for r in rows)


@pytest.mark.parametrize("compact", [10, 10 ** 9])
def test_runs_match_brute_force(monkeypatch, compact):
    monkeypatch.setattr(periodic, "COMPACT", compact)
    rnd = random.Random(5)
    for _ in range(600):
        n, kinds = rnd.randint(0, 110), rnd.choice([1, 2, 3, 5, 30])
        x = [rnd.randrange(kinds) for _ in range(n)]
        if n and rnd.random() < 0.7:
            a = rnd.randrange(n)
            p = 1 + (n - a) // rnd.randint(2, 9)
            x = [x[a + (i - a) % p] if i >= a else x[i] for i in range(n)]
            if rnd.random() < 0.5:
                x[rnd.randrange(n)] = 77
        least = rnd.choice([12, 12, 2, 5])
        assert periodic.runs_of(np.array(x, np.int64), least) == brute_runs(x, least)
        texts = [" ".join(map(str, y)) for y in (x, [1, 2, 3], x[::-1], x)]
        got = periodic.group_runs(texts, least)
        assert [r for r, _ in got] == [brute_runs(t.split(), least) for t in texts]


def test_colliding_hashes_lose_nothing(monkeypatch):
    """The prefilter may keep too much, never too little; with it off the runs are the same."""
    rnd = random.Random(1)
    words = np.array([rnd.randrange(3) for _ in range(2000)] + [1, 2, 3, 4, 5, 6, 7] * 9 + list(range(10, 900)))
    stretches = periodic.repetitive_stretches(words, np.zeros(len(words), np.int64))
    assert sum(b - a for a, b in stretches) < len(words) - 800
    assert sorted((s + a, n, q) for a, b in stretches for s, n, q in periodic.runs_of(words[a:b])) == sorted(
        periodic.runs_of(words))


def test_very_long_text():
    """A text of 50 MB: repeats far apart are cut away, its one run is found whole."""
    rnd = np.random.default_rng(2)
    words = [f"w{i}" for i in rnd.integers(0, 400_000, 7_400_000)]
    words[100_000:100_300] = [f"r{i % 50}" for i in range(300)]
    text = " ".join(words)
    assert len(text) > 50_000_000
    (runs, collapsed), = periodic.group_runs([text])
    assert runs == [(100_000, 300, 50)]
    assert collapsed.decode() == " ".join(words[:100_050] + words[100_300:])
