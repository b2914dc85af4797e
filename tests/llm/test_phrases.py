"""Phrase mining against brute force and SQL."""

import random
import re
from collections import Counter

import duckdb
import pytest

from marketlake.llm import phrases
from marketlake.llm.catalog import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import document, lower_az, rows_of, write_tables

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, least, top=2000):
    f, n = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower_az(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            if w:
                n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f.setdefault(lang, Counter())[tuple(w[i:i + k])] += 1
    out = []
    for lang, count in f.items():
        own = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in own.items():
            if any(100 * b >= 80 * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in own.items()):
                continue
            score, _, l, r = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]])
                                 for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def corpus():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["the", "Cat", "sat", "of", "ßü", "a", "e f", "\U0001f642", "￿"])
                      + rnd.choice(["", "", "", ".", ",\n", "\t", " \x0b", "\x1c"]) for _ in range(rnd.randint(0, 60)))
             for _ in range(60)]
    return [(rnd.choice(["en", "en", None, "und", "ß"]), t) for t in texts] + [(None, None), ("x", ""), ("x", " \n. ")]


@pytest.mark.parametrize("least, top, shared, group, bits", [(3, 2000, 10_000, 8 << 20, 27), (2, 7, 3, 300, 6), (5, 2000, 1, 40, 16)])
def test_matches_brute_force(spark, monkeypatch, least, top, shared, group, bits):
    """Whatever is cut into slices, however texts are grouped, and with a filter that lets nearly all through."""
    monkeypatch.setattr(phrases, "HOT_SHARE", shared)
    monkeypatch.setattr(phrases, "GROUP", group)
    monkeypatch.setattr(phrases, "MOST_BITS", bits)
    docs = corpus()
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    got = rows_of(phrases.collocations(df, least=least, top=top), *COLUMNS)
    assert sorted(got) == brute(docs, least, top)


def test_stripes_of_one_prefix_over_many_batches():
    import pyarrow as pa
    rows = [("0\ta\ten", "x 1 y 2")] * 7 + [("1\ta\ten", "z 30")] + [("0\tb c\te\tn", "x 29")] * 3
    batches = [pa.RecordBatch.from_pydict({"key": [k], "entries": [e]}) for k, e in rows]
    got = [tuple(r.values()) for b in phrases._merge(iter(batches), 10) for r in b.to_pylist()]
    assert got == [("en", "a", 0, 21, ["y"], [14]), ("en", "a", 1, 30, ["z"], [30]), ("e\tn", "b c", 0, 87, ["x"], [87])]


def sql_rows(root):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{root}/documents.parquet{'' if root == SF_SMALL else '/*.parquet'}')")
    return sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE['op13_phrases']})").fetchall())


def test_query_matches_sql(spark, odd, empty, tmp_path):
    many = write_tables(spark, str(tmp_path / "many"), [document(i, "One two, three four five six. " * 9 + "x y z" * (i % 2),
                                                                 ["en", None][i % 2]) for i in range(12)])
    for root in (SF_SMALL, odd, empty, many):
        got = QUERIES["op13_phrases"](spark, root)
        assert got.columns == COLUMNS
        assert sorted(rows_of(got, *COLUMNS)) == sql_rows(root)
    assert len(sql_rows(many)) > 2 and not sql_rows(empty)
