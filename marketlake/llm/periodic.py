"""Periodic runs of words: suffix automaton with link-cut access.

A run is a longest stretch of words that repeats with some smallest period at
least twice over.  The automaton of a text's words gives, for each prefix, the
states on its suffix-link path; a link-cut tree over the links keeps for every
state the last position its words ended at.  Appending word i is an access: the
whole path takes position i, and the pieces of equal colour it was made of are
passed from deep to shallow.  A piece of words longer than ``low`` and up to
``high`` that last ended at j is a square of period i - j if low < i - j <=
high, and the period is the smallest one, as the word half would have ended
later otherwise.  A square is extended both ways to its run once per period.

A run of at least ``LEAST`` words repeats some ``LEAST // 2`` words in a row at
each of its places.  So words that no such repeated shingle of their stretch
covers are in no run: they are cut away by hashes, again within what is left,
until nothing changes, and the automaton reads the stretches that remain.  A
run lies whole in one of them.

One pass over the texts, no shuffle; a text is read by one task.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import WORD, read, text_or_empty

LEAST = 12                                        # words of the shortest run
GROUP = 2 << 20                                   # bytes of texts whose shingles are hashed together
COMPACT = 100_000                                 # words from which states are kept as 32-bit integers
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
RUNS_DDL = "doc_id bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def suffix_automaton(words: list[int]) -> tuple:
    """(length, link, state of each prefix) for words numbered from 1; state 0 is the empty word.

    Most states have one transition, kept in two arrays; the others are in ``more``.
    """
    n = len(words)
    zeros = (lambda k: [0] * k) if n < COMPACT else (lambda k: array("i", bytes(4 * k)))
    length, link, first, target, state = zeros(2 * n + 1), zeros(2 * n + 1), zeros(2 * n + 1), zeros(2 * n + 1), zeros(n)
    more: dict[int, dict[int, int]] = {}
    link[0] = -1
    last, size = 0, 1
    for i, word in enumerate(words):
        new, size = size, size + 1
        length[new], state[i] = i + 1, new
        p, last = last, new
        while p >= 0:
            if first[p] == word:
                q = target[p]
                break
            if not first[p]:
                first[p], target[p] = word, new
            elif (moves := more.get(p)) is None:
                more[p] = {word: new}
            elif word in moves:
                q = moves[word]
                break
            else:
                moves[word] = new
            p = link[p]
        else:
            continue                              # the word is new: its link is the empty word
        if length[q] == length[p] + 1:
            link[new] = q
            continue
        copy, size = size, size + 1
        length[copy], link[copy], first[copy], target[copy] = length[p] + 1, link[q], first[q], target[q]
        if q in more:
            more[copy] = dict(more[q])
        link[q] = link[new] = copy
        while p >= 0:
            if first[p] == word:
                if target[p] != q:
                    break
                target[p] = copy
            elif (moves := more[p])[word] == q:
                moves[word] = copy
            else:
                break
            p = link[p]
    return length, link, state


class LinkCut:
    """A link-cut tree over suffix links: every preferred path is a splay tree of one colour, kept at its root.

    Left is shallower.  The empty word (0) is no node: paths end above it.
    """

    def __init__(self, link):
        n = len(link)
        zeros = (lambda: [0] * n) if isinstance(link, list) else (lambda: array("i", bytes(4 * n)))
        self.up, self.left, self.right, self.colour = link[:], zeros(), zeros(), zeros()
        self.up[0] = 0

    def splay(self, x: int) -> None:
        """Make x the root of its splay tree; the colour moves to it."""
        up, left, right = self.up, self.left, self.right
        p = up[x]
        if left[p] != x and right[p] != x or not p:
            return
        while True:
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                top, above = g, up[g]
                if left[p] == x:
                    if left[g] == p:
                        left[g] = b = right[p]
                        left[p] = c = right[x]
                        right[p], right[x] = g, p
                        up[g], up[p] = p, x
                        if b:
                            up[b] = g
                        if c:
                            up[c] = p
                    else:
                        right[g] = b = left[x]
                        left[p] = c = right[x]
                        left[x], right[x] = g, p
                        up[g] = up[p] = x
                        if b:
                            up[b] = g
                        if c:
                            up[c] = p
                elif right[g] == p:
                    right[g] = b = left[p]
                    right[p] = c = left[x]
                    left[p], left[x] = g, p
                    up[g], up[p] = p, x
                    if b:
                        up[b] = g
                    if c:
                        up[c] = p
                else:
                    left[g] = b = right[x]
                    right[p] = c = left[x]
                    right[x], left[x] = g, p
                    up[g] = up[p] = x
                    if b:
                        up[b] = g
                    if c:
                        up[c] = p
                up[x] = above
                if above:
                    if left[above] == g:
                        left[above] = x
                    elif right[above] == g:
                        right[above] = x
            else:
                top = p
                if left[p] == x:
                    left[p] = b = right[x]
                    right[x] = p
                else:
                    right[p] = b = left[x]
                    left[x] = p
                if b:
                    up[b] = p
                up[p], up[x] = x, g
            p = up[x]
            if not p or left[p] != x and right[p] != x:
                break
        self.colour[x] = self.colour[top]

    def access(self, x: int, colour: int) -> list[tuple[int, int]]:
        """Give the path of x the colour; returns what it was made of, deepest first: (deepest state, old colour)."""
        up, right, colours, splay, pieces, below = self.up, self.right, self.colour, self.splay, [], 0
        while x:
            splay(x)
            old = colours[x]
            pieces.append((x, old))
            if deeper := right[x]:
                colours[deeper] = old
            right[x], below, x = below, x, up[x]
        colours[below] = colour
        return pieces


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements of a and b are equal."""
    at, step, n = 0, 16, min(len(a), len(b))
    while at < n:
        differ = a[at:min(n, at + step)] != b[at:min(n, at + step)]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, 4 * step
    return n


def runs_of(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of at least ``least`` words and two periods, by start, then period."""
    values = (words + 1 - words.min()).tolist() if len(words) else []
    length, link, state = suffix_automaton(values)
    tree, found, known_to = LinkCut(link), [], {}
    access = tree.access
    for end in range(1, len(values) + 1):
        pieces = access(state[end - 1], end)
        for k, (deepest, before) in enumerate(pieces):
            period = end - before
            if before and period <= length[deepest] and known_to.get(period, 0) < end and (
                    k + 1 == len(pieces) or length[pieces[k + 1][0]] < period):
                stop = end + _agree(words[end:], words[end - period:])
                start = end - 2 * period - _agree(words[:end - 2 * period][::-1], words[:end - period][::-1])
                known_to[period] = stop
                if stop - start >= max(least, 2 * period):
                    found.append((start, stop - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def repetitive_stretches(words: np.ndarray, texts: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """(start, stop) of the stretches in which every run of ``least`` words or more lies.

    ``words`` are the words of several texts behind each other and ``texts``
    the text of each.  Equal hashes of different shingles only keep more.
    """
    width = max(1, least // 2)
    factors = np.random.default_rng(7).integers(1 << 62, (1 << 63) - 1, width + 1).astype(np.uint64) | np.uint64(1)
    at, label = np.arange(len(words)), texts
    while len(at) >= least:
        n = len(at) - width + 1
        inside = label[:n] == label[width - 1:]
        x = words[at].astype(np.uint64)
        key = label[:n].astype(np.uint64) * factors[width]
        for t in range(width):
            key += x[t:t + n] * factors[t]
        key ^= key >> np.uint64(29)
        key *= factors[0]
        bits = max(10, min(22, n.bit_length() + 2))
        where = np.flatnonzero(inside)
        bucket = (key[where] >> np.uint64(64 - bits)).astype(np.int64)
        where = where[np.bincount(bucket, minlength=1 << bits)[bucket] > 1]
        _, same, copies = np.unique(key[where], return_inverse=True, return_counts=True)
        where = where[copies[same] > 1]
        covered = np.zeros(len(at), bool)
        for t in range(width):
            covered[where + t] = True
        left = np.flatnonzero(covered)
        if not len(left):
            return []
        new = np.empty(len(left), bool)
        new[0], new[1:] = True, (np.diff(left) > 1) | (label[left[1:]] != label[left[:-1]])
        stretch = np.cumsum(new) - 1
        long = np.bincount(stretch)[stretch] >= least
        left, stretch = left[long], stretch[long]
        if len(left) == len(at):
            edge = np.flatnonzero(np.diff(stretch)) + 1
            return list(zip(at[np.r_[0, edge]].tolist(), (at[np.r_[edge - 1, len(at) - 1]] + 1).tolist()))
        at, label = at[left], stretch
    return []


def _collapsed(raw: bytes, starts: np.ndarray, ends: np.ndarray, runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    kept, at = [], 0
    for lo, hi in sorted((s + q, s + n) for s, n, q in runs):
        if lo > at:
            kept.append((at, lo))
        at = max(at, hi)
    if at < len(starts):
        kept.append((at, len(starts)))
    return b" ".join(b" ".join(raw[starts[a]:ends[b - 1]].split()) for a, b in kept)


def group_runs(texts: list[str], least: int = LEAST) -> list[tuple[list, bytes]]:
    """(runs, collapsed text) of each text; the texts are read together."""
    encoded = [t.encode() for t in texts]
    raw = b"\n".join(encoded)
    space = SPACES[np.frombuffer(raw, np.uint8)]
    edge = np.diff(np.r_[True, space, True].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    at = np.cumsum([0] + [len(e) + 1 for e in encoded])
    first = np.searchsorted(starts, at)
    del encoded, space, edge
    number = defaultdict(count().__next__)
    words = np.empty(len(starts), np.int64)
    for lo in range(0, len(starts), 1 << 19):     # split a bounded part at a time
        hi = min(len(starts), lo + (1 << 19))
        words[lo:hi] = np.fromiter(map(number.__getitem__, raw[starts[lo]:ends[hi - 1]].split()), np.int64, hi - lo)
    runs: list[list] = [[] for _ in texts]
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    for lo, hi in repetitive_stretches(words, owner, least):
        own, shift = owner[lo], lo - int(first[owner[lo]])
        runs[own] += [(s + shift, n, q) for s, n, q in runs_of(words[lo:hi], least)]
    return [(runs[i], _collapsed(raw, starts[a:b], ends[a:b], runs[i]))
            for i, (a, b) in enumerate(zip(first, first[1:]))]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: doc_id, runs (start, length, period) by start and period, collapsed.

    ``collapsed`` holds the words joined by one space, without those that any
    run holds after its first period.  A null or empty text has no words, no
    run and an empty collapsed text; repeated rows each give a row, null ids
    too; an empty table gives none; other columns are not read.
    """
    def run(batches):
        def emit(ids, texts):
            results = group_runs(texts, least)
            flat = np.array([r for runs, _ in results for r in runs], np.int64).reshape(-1, 3)
            struct = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
            offsets = pa.array(np.cumsum([0] + [len(runs) for runs, _ in results]), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(offsets, struct),
                 pa.array([c.decode() for _, c in results], pa.string())], names=["doc_id", "runs", "collapsed"])

        for b in batches:
            ids, texts, total = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py()
                ids.append(i)
                texts.append(t)
                total += len(t) + 1
                if total >= GROUP:
                    yield emit(ids, texts)
                    ids, texts, total = [], [], 0
            if ids:
                yield emit(ids, texts)

    source = docs.select(F.col(doc_id).cast("bigint").alias("d"), text_or_empty(text).alias("t"))
    return source.mapInArrow(run, RUNS_DDL)


def planted(doc_id: Column, text: Column) -> Column:
    """The contract's text: where crc32(doc_id) is a multiple of 10, words from one place on repeat a period."""
    h = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    g = F.floor(h / 10)

    def repeat(s: Column) -> Column:
        return F.array_join(F.transform(s["w"], lambda word, i: F.when(i < s["a"], word).otherwise(
            F.get(s["w"], (s["a"] + (i - s["a"]) % s["p"]).cast("int")))), " ")

    def place(s: Column) -> Column:
        a = g % F.size(s["w"])
        p = 1 + F.floor((F.size(s["w"]) - a) / (3 + g % 8))
        return F.struct(s["w"].alias("w"), a.alias("a"), p.alias("p"))

    # each array of one element names a value that is then computed once
    words = F.array(F.struct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w")))
    whole = F.filter(words, lambda s: F.size(s["w"]) > 0)
    return F.when(h % 10 == 0, F.get(F.transform(F.transform(whole, place), repeat), F.lit(0))).otherwise(text)


def op11_periodic_runs(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.s")).alias("start"),
                    F.col("best.length").alias("length"), (-F.col("best.q")).alias("period"),
                    F.floor(1000 * F.col("best.length") / -F.col("best.q")).cast("bigint").alias("exponent_milli"),
                    digest(lines).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256")))
