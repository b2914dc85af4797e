"""HMM scores, nearest neighbours, chat formatting, mixing and the pipeline."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import ann, chat, hmm, mixing
from marketlake.llm.catalog import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import lower_az, rows_of

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", params=["small", "odd", "empty"])
def root(request):
    return SF_SMALL if request.param == "small" else request.getfixturevalue(request.param)


def files(root, name):
    return f"{root}/{name}.parquet" if root == SF_SMALL else f"{root}/{name}.parquet/*.parquet"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_oracle(spark, root, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{files(root, t)}')")
    res = con.execute(ORACLE[name])
    columns = [c[0] for c in res.description]
    expected = Counter(res.fetchall())
    df = QUERIES[name](spark, root)
    assert sorted(df.columns) == sorted(columns)
    if name == "op6_exact_dedup" and root != SF_SMALL:    # of repeated rows, and rows without id, one stays
        columns.remove("kept")
        expected = Counter(con.execute(f"SELECT {','.join(columns)} FROM ({ORACLE[name]})").fetchall())
    assert Counter(rows_of(df, *columns)) == expected


# --- HMM

def direct(tokens, start, move, emit):
    a, log = start * emit[tokens[0]], 0.0
    for c in tokens[1:]:
        log += math.log10(a.sum())
        a = (a / a.sum()) @ move * emit[c]
    return log + math.log10(a.sum())


def test_likelihood_equals_plain_forward_recursion():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 700, 300, 129, 128, 1000, 742])
    tokens = rng.integers(0, 50, lengths.sum())
    start, move, emit = hmm.initial(np.ones(50), 3)
    emit = np.ascontiguousarray(emit.T)
    got = hmm.log10_likelihood(tokens, lengths, start, move, emit)
    begin = np.cumsum(lengths) - lengths
    assert np.allclose(got, [direct(tokens[a:a + n], start, move, emit) for a, n in zip(begin, lengths)], atol=1e-9)


def test_expected_counts_equal_enumeration():
    start, move, emit = hmm.initial(np.ones(4), 2)
    emit = np.ascontiguousarray(emit.T)
    tokens = np.array([0, 3, 1, 2, 2])
    first, moves, emitted = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 4))
    total = 0.0
    for path in np.ndindex(*(2,) * 5):
        p = start[path[0]] * emit[tokens[0], path[0]]
        for t in range(1, 5):
            p *= move[path[t - 1], path[t]] * emit[tokens[t], path[t]]
        total += p
        first[path[0]] += p
        for t in range(5):
            emitted[path[t], tokens[t]] += p
            if t:
                moves[path[t - 1], path[t]] += p
    got = hmm.expected_counts(tokens, np.array([5]), start, move, emit)
    for a, b in zip(got, (first, moves, emitted)):
        assert np.allclose(a, b / total)


def test_baum_welch_raises_the_likelihood(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    total = [hmm.hmm_scores(docs, F.lit(False), rounds=r).agg(F.sum("score")).first()[0] for r in (0, 1, 4)]
    assert total[0] < total[1] < total[2]


def test_hmm_scores_against_brute_force(spark, root):
    docs = rows_of(spark.read.parquet(f"{root}/documents.parquet"), "doc_id", "text")
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs}
    tokens = [(d, WORDS.findall(lower_az(t)) + ["\n"]) for d, t in docs]
    count = Counter(w for d, x in tokens if not held[d] for w in x)
    n, v = sum(count.values()), len(count)
    expected = sorted(((d or -1, held[d], len(x), sum(count[w] > 0 for w in x), n,
                        sum(math.log10((count[w] + 1) / (n + v + 1)) for w in x)) for d, x in tokens))
    got = sorted((r[0] or -1, *r[1:]) for r in rows_of(
        QUERIES["op7_hmm_scores"](spark, root), "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5] for r in got], [r[5] for r in expected])


def test_hmm_score_of_each_document_equals_a_plain_forward_recursion(spark):
    rng = np.random.default_rng(4)
    words = ["alpha", "beta", "gamma", "delta", "running", "walking", "x", "yy", "zz9"]
    docs = [(i, " ".join(rng.choice(words, n))) for i, n in enumerate((0, 1, 5, 40, 127, 128, 129, 300, 700))]
    docs += [(20, "unseen words only"), (21, "alpha unseen beta"), (22, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    held = F.col("doc_id") >= 20
    tokens = {i: [w.encode() for w in (t or "").split()] + [hmm.END] for i, t in docs}
    count = Counter(w for i, x in tokens.items() if i < 20 for w in x)
    size, distinct = np.zeros(hmm.CLASSES), np.zeros(hmm.CLASSES)
    for w, n in count.items():
        size[hmm.word_class(w)] += n
        distinct[hmm.word_class(w)] += 1
    start, move, emit = hmm.baum_welch(hmm.encode(frame, held), hmm.initial(size, 3), 2)
    emit = np.ascontiguousarray(emit.T)
    got = dict(rows_of(hmm.hmm_scores(frame, held, states=3, rounds=2), "doc_id", "score"))
    for i, x in tokens.items():
        classes = [hmm.word_class(w) for w in x]
        words_given_class = sum(math.log10((count[w] + 1) / (size[c] + distinct[c] + 1)) for w, c in zip(x, classes))
        assert abs(direct(classes, start, move, emit) + words_given_class - got[i]) < 1e-5, i


def test_hmm_beats_the_base_on_held_out_texts(spark):
    out = QUERIES["op7_hmm_scores"](spark, SF_SMALL)
    base, score = out.filter("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base


def test_word_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(1, "aa bb aa cc")], "doc_id long, text string")
    one = spark.createDataFrame([(2, ""), (3, "aa"), (4, "zz")], "doc_id long, text string")
    out = hmm.hmm_scores(docs.union(one), F.col("doc_id") > 1, rounds=2)
    assert all(s < 0 and math.isfinite(s) for _, s in rows_of(out, "doc_id", "score"))


# --- nearest neighbours

def test_nearest_neighbours_recall_and_scores(spark, root):
    table = [(i, v) for i, v in rows_of(spark.read.parquet(f"{root}/embeddings.parquet"), "vec_id", "embedding")
             if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    dims = Counter(len(v) for _, v in table).most_common(1)
    best = {}
    for i, v in table:
        if len(v) == dims[0][0]:
            best[i] = min(best.get(i, v), v)
    ids, x = np.array(sorted(best)), np.array([best[i] for i in sorted(best)], float)
    got = {}
    for q, r, i, s in sorted(rows_of(QUERIES["op4_nearest_neighbours"](spark, root), "query_id", "rank", "vec_id", "score")):
        got.setdefault(q, []).append((r, i, s))
    assert sorted(got) == [i for i in ids if i % 100 == 0]
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        own = dict(zip(ids.tolist(), d))
        order = [int(i) for i in ids[np.lexsort((ids, d))] if i != q][:10]
        assert [r for r, _, _ in found] == list(range(1, len(order) + 1))
        assert all(s == own[i] for _, i, s in found)
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & set(order)) / len(order)
    assert not got or hits / len(got) >= 0.9


def test_probing_retrieves_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 16, (3000, 8)).astype(np.uint16)
    codes[100:200] = codes[0] ^ (1 << rng.integers(0, 16, (100, 8))).astype(np.uint16)
    index = ann.Directories(codes)
    for radius in (0, 3, 8, 20, 54, 60, 128):
        assert np.array_equal(index.within(codes[0], radius), np.flatnonzero(ann.hamming(codes, codes[0]) <= radius))


def test_few_candidates_are_all_returned(spark):
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "vec_id long, embedding array<float>")
    got = rows_of(ann.nearest(vectors, F.col("vec_id") == 0, block_rows=2), "query_id", "rank", "vec_id")
    assert sorted(got) == [(0, r, r) for r in range(1, 5)]


# --- chat

def test_chat_round_trip_and_states(spark, odd):
    out = chat.format_chats(spark.read.parquet(f"{odd}/conversations.parquet"))
    back = {c: [(t["role"], t["text"]) for t in turns]
            for c, turns in out.select("conv_id", chat.read_turns(F.col("formatted"))).collect()}
    assert back[1] == [("system", "a<|im_end|>\\n"), ("user", "hi"), ("assistant", "<|im_start|>ok\\")]
    assert back[2] == [("", ""), ("assistant", ""), ("assistant", "")]
    assert back[3] == [("ro\nle\\n<|im_end|>", "<")]
    valid = dict(rows_of(out, "conv_id", "valid"))
    assert valid[1] and not valid[2] and not valid[3] and not valid[4] and None in valid
    for c, formatted, segments in rows_of(out, "conv_id", "formatted", "segments"):
        assert formatted == "".join(s["text"] for s in segments)
        assert formatted.count(chat.START) == len(back[c])


# --- mixing

def test_mix_meets_targets(spark):
    out = QUERIES["op8_mixing"](spark, "/root/testdata/sf0.01")
    assert out.filter("taken > 3 * size OR taken < 0").count() == 0
    per = out.groupBy("source_size", "target").agg(F.sum("taken").alias("t"), F.max("size").alias("m")).collect()
    assert all(abs(r["t"] - r["target"]) <= r["m"] / 2 + 1 for r in per)


@pytest.mark.parametrize("sizes", [[5, 5, 5], [100, 1, 1], [0, 0], [7], [1, 1, 1, 1000, 0, 3]])
def test_targets_level(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    total, left, goal = sum(sizes), dict(enumerate(sizes)), {}
    while left:                                              # reshare the excess until no source is above its cap
        share = (total - sum(goal.values())) / sum(i % 3 + 1 for i in left)
        over = [i for i in left if share * (i % 3 + 1) > 3 * sizes[i]]
        for i in over or list(left):
            goal[i] = 3 * sizes[i] if over else share * (i % 3 + 1)
            del left[i]
    assert all(got[f"s{i}"] == pytest.approx(goal[i]) for i in goal)


def test_mix_takes_rows_without_words_with_complete_epochs_only(spark, tmp_path):
    docs = [(i, "one two three" if i % 2 else "", "ab"[i % 4 // 2]) for i in range(400)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/d")
    taken = Counter(rows_of(mixing.mix(spark.read.parquet(f"{tmp_path}/d")), "doc_id", "source"))
    words = {d: bool(t) for d, t, _ in docs}
    for source, target in (("a", 300 * 2 / 3), ("b", 300 * 4 / 3)):      # weights 1 and 2, 300 words each
        empties = {taken[d, s] for d, _, s in docs if s == source and not words[d]}
        assert empties == {int(target // 300)}
        assert abs(3 * sum(n for (d, s), n in taken.items() if s == source and words[d]) - target) <= 3


def test_mix_repeats_rows_whole(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    taken = Counter(rows_of(out, "doc_id", "text", "source"))
    assert max(taken.values()) <= 3 * max(Counter(rows_of(docs, "doc_id", "text", "source")).values())
    assert Counter(rows_of(mixing.mix(docs), "doc_id", "text", "source")) == taken


# --- pipeline

def test_pipeline_stages(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet")
    source = spark.read.parquet(f"{root}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.save(stage(spark, docs, root), f"t-{name}")
        seen[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == source.columns
            assert docs.select("doc_id", "text").subtract(source.select("doc_id", "text")).count() == 0
    texts = rows_of(seen["near_dedup"], "text")
    assert len(texts) == len(set(texts))
    tokens = seen["best_fit_packing"].groupBy("doc_id").agg(F.sum("length").alias("n"))
    assert tokens.count() == seen["mix_sources"].select("doc_id").distinct().count()


def test_pipeline_run_equals_brute_force(spark):
    from tests.llm.test_text_operators import brute_fingerprint
    docs = rows_of(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), "doc_id", "text", "source")
    last = {lower_az(t): d for d, t, _ in sorted(docs)}
    docs = [r for r in docs if last[lower_az(r[1])] == r[0]]
    fps = np.array([brute_fingerprint(t) for _, t, _ in docs], np.uint64)
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3):
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
    kept = {min(d for (d, _, _), x in zip(docs, label) if x == g) for g in label}
    staged = spark.createDataFrame([r for r in docs if r[0] in kept], "doc_id long, text string, source string")
    expected = Counter(rows_of(mixing.mix(staged), "doc_id"))
    pieces = rows_of(corpus_pipeline.run(spark, SF_SMALL).filter("piece = 0"), "doc_id")
    assert Counter(pieces) == expected


@pytest.mark.parametrize("chars", [5, 60, 300, 100_000])
def test_mixing_ranges_are_even_for_any_weight(spark, chars):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"),
                                    F.expr(f"repeat(substr(md5(CAST(id AS STRING)), 1, 5), {chars} DIV 5)").alias("text"))
    rows = mixing.keyed(docs, mixing.PLAIN).drop("text")
    largest = rows.groupBy("range").count().agg(F.max("count")).first()[0]
    salted = rows.groupBy(F.col("range") % mixing.SALTS).count().agg(F.max("count")).first()[0]
    assert largest <= 20 and salted <= 4 * 4000 / mixing.SALTS
    wrong = rows.selectExpr("key", "range", "lag(range) OVER (ORDER BY key) AS before").filter("before > range")
    assert wrong.count() == 0
