"""LM scoring with a hidden Markov language model.

A latent state emits a word class (a hash of the word's last letters), the
class emits the word by its training count.  States are trained by Baum-Welch:
every task runs scaled forward-backward over its passages, the expected counts
are summed across partitions, the driver normalises tables of fixed size, and
the next round starts.  A text's log probability is the exact likelihood of
its whole word sequence by the scaled forward recursion, however long it is:
segments are reduced to transfer matrices, which are multiplied in order.

Texts are encoded once, into chunks with a vocabulary of their own and token
numbers in it.  Counts of all training words are one aggregate of (word key,
count); each chunk gets the counts of its own words back by a join on the key.
Nothing that grows with the corpus is broadcast or read by the driver: a word
is in a shuffle once per chunk, a chunk has about ``CHUNK_TOKENS`` tokens, and
the driver sees tables of STATES x CLASSES.

Word keys have 64 bits (the class above a hash of the word), so two of n
distinct words share one with probability below n**2 / 2**65.
"""

from __future__ import annotations

from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import crc_mod, read, save, text_or_empty

STATES = 4
LOG2_CLASSES = 14
CLASSES = 1 << LOG2_CLASSES
SUFFIX = 4                                          # bytes at the end of a word that make its class
ROUNDS = 6
PASSAGE = 256                                       # training sequences: whole texts cut into passages
SEGMENT = 128
BLOCK = 4096                                        # passages or segments advanced together
CHUNK_TOKENS = 2_000_000
SMOOTHING = 0.1
END = b"\n"                                         # no word holds a line end
CHUNK_DDL = ("chunk bigint, doc_ids array<bigint>, held array<boolean>, lengths binary, ids binary, "
             "keys binary, classes binary, counts binary")


def word_class(word: bytes) -> int:
    return crc32(word[-SUFFIX:]) & (CLASSES - 1)


def encode(docs: DataFrame, held: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks of encoded texts: per document its tokens (words, then END), per chunk its words."""
    from xxhash import xxh64_intdigest

    def run(batches):
        base, number = TaskContext.get().partitionId() << 32, count()

        def chunk(docs_, flags, lengths, tokens, vocabulary):
            ids, lengths = np.concatenate(tokens), np.array(lengths, "<i4")
            words = list(vocabulary)
            classes = np.array([word_class(w) for w in words], "<u2")
            hashes = np.array([xxh64_intdigest(w) for w in words], np.uint64)
            keys = classes.astype(np.uint64) << np.uint64(64 - LOG2_CLASSES) | hashes >> np.uint64(LOG2_CLASSES)
            trained = np.repeat(~np.array(flags, bool), lengths)
            counts = np.bincount(ids[trained], minlength=len(words)).astype("<i8")
            return pa.RecordBatch.from_arrays(
                [pa.array([base + next(number)]), pa.array([docs_], pa.list_(pa.int64())),
                 pa.array([flags], pa.list_(pa.bool_()))]
                + [pa.array([a.tobytes()], pa.binary()) for a in (lengths, ids, keys.view("<i8"), classes, counts)],
                names=["chunk", "doc_ids", "held", "lengths", "ids", "keys", "classes", "counts"])

        class Vocabulary(dict):
            def __missing__(self, word):
                self[word] = n = len(self)
                return n

        docs_, flags, lengths, tokens, vocabulary, total = [], [], [], [], Vocabulary(), 0
        for b in batches:
            for d, h, t in zip(*(b.column(i).to_pylist() for i in range(3))):
                words = t.encode().lower().split()
                words.append(END)
                tokens.append(np.fromiter(map(vocabulary.__getitem__, words), "<u4", len(words)))
                docs_.append(d)
                flags.append(h)
                lengths.append(len(words))
                total += len(words)
                if total >= CHUNK_TOKENS:
                    yield chunk(docs_, flags, lengths, tokens, vocabulary)
                    docs_, flags, lengths, tokens, vocabulary, total = [], [], [], [], Vocabulary(), 0
        if docs_:
            yield chunk(docs_, flags, lengths, tokens, vocabulary)

    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), held.alias("h"), text_or_empty(text).alias("t"))
    return source.select("doc_id", "h", "t").mapInArrow(run, CHUNK_DDL)


def cut(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, start, length) of the pieces of all sequences, in order."""
    pieces = -(-lengths // most)
    owner = np.repeat(np.arange(len(lengths)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = (np.cumsum(lengths) - lengths)[owner] + nth * most
    return owner, begin, np.minimum(most, lengths[owner] - nth * most)


def expected_counts(classes: np.ndarray, lengths: np.ndarray, start, move, emit) -> tuple:
    """Baum-Welch counts over all sequences: first states, transitions, emissions by class.

    ``emit`` is (classes, states).  Sequences are advanced together, longest
    first, so that those still running are always the first ones.
    """
    k = len(start)
    first, moves, emitted = np.zeros(k), np.zeros((k, k)), np.zeros((k, len(emit)))
    _, begin, size = cut(lengths, PASSAGE)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    for lo in range(0, len(size), BLOCK):
        at, n = begin[lo:lo + BLOCK], size[lo:lo + BLOCK]
        steps = int(n[0])
        running = np.searchsorted(-n, -np.arange(steps), side="left")      # sequences longer than t
        seen = [classes[at[:m] + t] for t, m in enumerate(running)]
        forward, scales = [], []
        for t, m in enumerate(running):
            a = (start if t == 0 else forward[-1][:m] @ move) * emit[seen[t]]
            s = a.sum(axis=1, keepdims=True)
            forward.append(a / s)
            scales.append(s)
        inner, ahead = np.zeros((k, k)), None
        gammas = []
        for t in range(steps - 1, -1, -1):
            back = np.ones_like(forward[t])
            if ahead is not None:
                m = len(ahead)
                inner += forward[t][:m].T @ ahead
                back[:m] = ahead @ move.T
            gammas.append(forward[t] * back)
            ahead = emit[seen[t]] * back / scales[t]
        first += gammas[-1].sum(axis=0)
        moves += move * inner
        gamma, which = np.concatenate(gammas), np.concatenate(seen[::-1])
        for s in range(k):
            emitted[s] += np.bincount(which, gamma[:, s], len(emit))
    return first, moves, emitted


def log10_likelihood(classes: np.ndarray, lengths: np.ndarray, start, move, emit) -> np.ndarray:
    """Exact log10 probability of each whole sequence, by segments' transfer matrices."""
    k, eye = len(start), np.eye(len(start))
    owner, begin, size = cut(lengths, SEGMENT)
    matrices, logs = np.empty((len(size), k, k)), np.zeros(len(size))
    opening = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
    order = np.argsort(-size, kind="stable")
    for lo in range(0, len(size), BLOCK):
        own = order[lo:lo + BLOCK]
        at, n = begin[own], size[own]
        m = np.where(opening[own, None, None], eye, move)
        log = np.zeros(len(own))
        for t in range(int(n[0])):
            r = int(np.searchsorted(-n, -t, side="left"))
            part = m[:r] if t == 0 else (m[:r].reshape(-1, k) @ move).reshape(r, k, k)
            part = part * emit[classes[at[:r] + t]][:, None, :]
            s = part.sum(axis=(1, 2))
            m[:r] = part / s[:, None, None]
            log[:r] += np.log10(s)
        matrices[own], logs[own] = m, log
    out, state = np.zeros(len(lengths)), np.tile(start, (len(lengths), 1))
    pieces = -(-lengths // SEGMENT)
    offset, most_first = np.cumsum(pieces) - pieces, np.argsort(-pieces, kind="stable")
    for j in range(int(pieces.max(initial=0))):
        docs = most_first[:int((pieces > j).sum())]
        piece = offset[docs] + j
        v = np.einsum("dk,dkl->dl", state[docs], matrices[piece])
        s = v.sum(axis=1)
        out[docs] += np.log10(s) + logs[piece]
        state[docs] = v / s[:, None]
    return out


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, lengths = np.frombuffer(row["ids"], "<u4"), np.frombuffer(row["lengths"], "<i4").astype(np.int64)
    return ids, lengths, np.frombuffer(row["classes"], "<u2")


def initial(class_counts: np.ndarray, states: int = STATES, seed: int = 5) -> tuple:
    """Start values: class frequencies shaken apart per state; states that tend to stay."""
    rng = np.random.default_rng(seed)
    emit = (class_counts + SMOOTHING) * np.exp(rng.normal(0, 0.7, (states, len(class_counts))))
    move = np.full((states, states), 0.05 / max(1, states - 1)) + np.eye(states) * 0.95
    return (np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True),
            emit / emit.sum(axis=1, keepdims=True))


def baum_welch(chunks: DataFrame, model: tuple, rounds: int = ROUNDS) -> tuple:
    """(start, move, emit) after ``rounds`` rounds over all training texts."""
    spark, k = chunks.sparkSession, len(model[0])
    rows = chunks.select("held", "lengths", "ids", "classes")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((model[0], model[1], np.ascontiguousarray(model[2].T)))

        def run(batches, shared=shared):
            start, move, emit = (x.astype(np.float32) for x in shared.value)
            total = np.zeros(k + k * k + k * len(emit))
            for b in batches:
                for row in b.to_pylist():
                    ids, lengths, classes = _arrays(row)
                    keep = ~np.array(row["held"], bool)
                    if keep.any():
                        tokens = classes[ids[np.repeat(keep, lengths)]].astype(np.int64)
                        got = expected_counts(tokens, lengths[keep], start, move, emit)
                        total += np.concatenate([x.ravel() for x in got])
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["at", "n"])

        sums = (rows.mapInArrow(run, "at bigint, n double").groupBy("at").agg(F.sum("n").alias("n"))).toArrow()
        total = np.zeros(k + k * k + model[2].size)          # fixed size, whatever the corpus
        total[sums["at"].to_numpy()] = sums["n"].to_numpy()
        first, moves, emitted = total[:k] + SMOOTHING, total[k:k + k * k].reshape(k, k) + SMOOTHING, \
            total[k + k * k:].reshape(k, -1) + SMOOTHING / 10
        model = (first / first.sum(), moves / moves.sum(axis=1, keepdims=True),
                 emitted / emitted.sum(axis=1, keepdims=True))
        shared.unpersist()
    return model


def word_counts(chunks: DataFrame) -> DataFrame:
    """(key, c): training count of every word with one."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                keys, counts = np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["counts"], "<i8")
                own = counts > 0
                yield pa.RecordBatch.from_arrays([pa.array(keys[own]), pa.array(counts[own])], names=["key", "c"])

    rows = chunks.select("keys", "counts").mapInArrow(run, "key bigint, c bigint")
    return rows.groupBy("key").agg(F.sum("c").alias("c"))


def _vocabularies(chunks: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                keys = np.frombuffer(row["keys"], "<i8")
                for lo in range(0, len(keys), 1 << 16):
                    part = keys[lo:lo + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), row["chunk"])), pa.array(np.arange(lo, lo + len(part), dtype=np.int32)),
                         pa.array(part)], names=["chunk", "word", "key"])

    return chunks.select("chunk", "keys").mapInArrow(run, "chunk bigint, word int, key bigint")


def hmm_scores(docs: DataFrame, held: Column, states: int = STATES, rounds: int = ROUNDS,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows that ``held`` does not mark.  A null or
    empty text is its end token alone.  An unknown word has the share of one
    more word of its class, so the model's probabilities of all words, known
    and unknown, sum to one.  With nothing to learn from, every class is
    alike.  Repeated rows count as often as they are there; an empty table
    gives no rows; other columns are not read.
    """
    chunks = save(encode(docs, held, doc_id, text), "hmm-chunks")
    words = save(word_counts(chunks), "hmm-words")
    by_class = words.groupBy(F.shiftrightunsigned("key", 64 - LOG2_CLASSES).cast("int").alias("class")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).toArrow()      # at most CLASSES rows
    tokens, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    tokens[by_class["class"].to_numpy()] = by_class["c"].to_numpy()
    distinct[by_class["class"].to_numpy()] = by_class["v"].to_numpy()
    n_all, v_all = int(tokens.sum()), int(distinct.sum())
    model = baum_welch(chunks, initial(tokens, states), rounds)
    shared = docs.sparkSession.sparkContext.broadcast((model[0], model[1], np.ascontiguousarray(model[2].T),
                                                       np.log10(tokens + distinct + 1)))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        start, move, emit, log_size = shared.value
        row = left.to_pylist()[0]
        ids, lengths, classes = _arrays(row)
        counts = np.zeros(len(classes), np.int64)
        counts[right["word"].to_numpy()] = right["c"].to_numpy()
        begin = np.cumsum(lengths) - lengths
        one_more = np.log10(counts + 1)

        def per_doc(value):
            return np.add.reduceat(value[ids], begin)

        likelihood = log10_likelihood(classes[ids].astype(np.int64), lengths, start, move, emit)
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()),
            "n_tokens": pa.array(lengths), "n_known": pa.array(per_doc((counts > 0).astype(np.int64))),
            "base_score": pa.array(per_doc(one_more - np.log10(n_all + v_all + 1))),
            "score": pa.array(likelihood + per_doc(one_more - log_size[classes]))})

    known = _vocabularies(chunks).join(words, "key").select("chunk", "word", "c")
    out = (chunks.select("chunk", "doc_ids", "held", "lengths", "ids", "classes").groupBy("chunk")
           .cogroup(known.groupBy("chunk"))
           .applyInArrow(lambda left, right: score(left, right),
                         "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                         "base_score double, score double"))
    return out.withColumn("train_tokens", F.lit(n_all).cast("bigint"))


def op7_hmm_scores(spark, sf_dir) -> DataFrame:
    out = hmm_scores(read(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
