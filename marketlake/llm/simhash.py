"""SimHash near-dedup by tiled exact comparison.

Every whole text gets a 64-bit fingerprint of its word shingles.  Distinct
fingerprints are dealt into tiles by population counts: the counts of set bits
in the four 16-bit quarters.  Two fingerprints within the radius differ by at
most the radius in these four counts together, so only tile pairs that near
are compared; all others are skipped.  A compared pair of tiles is one numpy
exclusive-or and bit count over all its fingerprints: nothing is hashed or
sampled, so no link is lost.  A tile holds about ``tile_rows`` fingerprints: a
crowded cell is cut into several tiles by a hash, so one crowded spot is many
tasks' work.

Links are not listed: each tile pair, and then each task, passes on a spanning
forest of what it found, and components are taken over distinct fingerprints.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import as_table, read, save, text_or_empty, with_row_key, without
from marketlake.llm.graph import components

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
TILE_ROWS = 4096
QUARTERS = 4                                        # 16 bits each; 17**4 cells at most
STRIP = 256
FOREST_NODES = 1_000_000


def fingerprint(text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of the XXH64 hashes of all shingles; A-Z lower-cased; no words: 0.

    A bit is set if more than half of the shingles, repeats counted, have it.
    """
    from xxhash import xxh64_intdigest
    tokens = text.encode().lower().split()          # bytes: ASCII white space and A-Z only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(tokens) - words + 1)
    spans = zip(starts[:n].tolist(), ends[min(words, len(tokens)) - 1:].tolist())
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in spans), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(doc_id, row_key, fp): the fingerprint as a signed 64-bit integer."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "row_key", "fp"])

    source = with_row_key(docs, columns={"d": F.col(doc_id).cast("bigint"), "t": text_or_empty(text)})
    return source.select("d", "_row_key", "t").mapInArrow(run, "doc_id bigint, row_key bigint, fp bigint")


def _steps(radius: int) -> list[tuple[int, ...]]:
    """One of each two opposite steps between cells whose counts differ by ``radius`` at most; 0 first."""
    span = range(-radius, radius + 1)
    steps = [s for s in itertools.product(span, repeat=QUARTERS) if sum(map(abs, s)) <= radius]
    return sorted(s for s in steps if s >= (0,) * QUARTERS)


def _quarter_counts():
    return [F.bit_count(F.shiftrightunsigned("fp", 16 * q).bitwiseAND(F.lit(0xFFFF))).cast("int")
            for q in range(QUARTERS)]


def _linked(a: np.ndarray, b: np.ndarray, radius: int, same: bool):
    """Edges (index in a, index in b) that span every group linked between two tiles."""
    label = np.arange(len(b))                       # group of each b, named by one of its members
    edges = []
    for at in range(0, len(a), STRIP):
        near = np.bitwise_count(a[at:at + STRIP, None] ^ b[None, :]) <= radius
        if same:                                    # above the diagonal: each pair once
            near &= np.arange(at, at + len(near))[:, None] < np.arange(len(b))[None, :]
        for i in np.flatnonzero(near.any(axis=1)):
            mine = np.flatnonzero(near[i])
            groups, first = np.unique(label[mine], return_index=True)
            edges += [(at + i, int(mine[k])) for k in first]
            if len(groups) > 1:
                label[np.isin(label, groups)] = groups[0]
    return edges


class _Forest:
    """Passes on an edge only if it joins two trees; forgets all when it grows too large."""

    def __init__(self, most: int = FOREST_NODES):
        self.up: dict[int, int] = {}
        self.most = most

    def _root(self, x: int) -> int:
        up = self.up
        while (p := up.setdefault(x, x)) != x:
            up[x] = x = up[p]
        return x

    def joins(self, u: int, v: int) -> bool:
        if len(self.up) > self.most:
            self.up = {}
        a, b = self._root(u), self._root(v)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def links(distinct: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column fp) that span all links within ``radius``."""
    counts = [f"c{q}" for q in range(QUARTERS)]
    base = distinct.select("fp", *[c.alias(n) for c, n in zip(_quarter_counts(), counts)])
    # at most 17**4 rows, so safe to send to every task
    cells = F.broadcast(base.groupBy(*counts).agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("tiles")))
    tiles = save(base.join(cells, counts)
                 .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
                 .groupBy(*counts, "tile").agg(F.sort_array(F.collect_list("fp")).alias("fps")), "tiles")
    steps = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(s, counts)]) for s in _steps(radius)])
    probe = tiles.withColumn("s", F.explode(steps)).select(
        F.col("tile").alias("from_tile"), F.col("fps").alias("a"),
        *[(F.col(n) + F.col("s")[n]).alias(n) for n in counts],
        F.forall(F.array(*[F.col("s")[n] for n in counts]), lambda x: x == 0).alias("same"))
    pairs = (probe.join(cells, counts)
             .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .filter(~F.col("same") | (F.col("tile") >= F.col("from_tile")))
             .join(tiles.select(*counts, "tile", F.col("fps").alias("b")), [*counts, "tile"])
             .select("a", "b", (F.col("same") & (F.col("tile") == F.col("from_tile"))).alias("same")))

    def run(batches):
        forest = _Forest()
        for batch in batches:
            u, v = [], []
            a_, b_, same_ = (batch.column(i) for i in range(3))
            for i in range(batch.num_rows):
                a, b = a_[i].values.to_numpy(), b_[i].values.to_numpy()
                for x, y in _linked(a.view(np.uint64), b.view(np.uint64), radius, same_[i].as_py()):
                    if forest.joins(int(a[x]), int(b[y])):
                        u.append(int(a[x]))
                        v.append(int(b[y]))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return pairs.mapInArrow(run, "u bigint, v bigint")


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, row_key, fp, component_id, stays.

    component_id is the smallest doc_id reachable over links, the row's own
    included; null if no row of the group has an id.  ``stays`` marks one row
    of each group: that with this id (of repeated rows exactly one).  Null and
    word-less texts have fingerprint 0 and link like any other.  An empty
    table gives no rows; other columns are not read.
    """
    rows = save(fingerprints(docs, words, doc_id, text), "fingerprints")
    rank = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    distinct = save(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min_by("row_key", rank).alias("row"),
                                           F.min(rank).alias("rank")), "distinct-fps")
    found = components(save(links(distinct, radius), "links"))
    named = distinct.join(found.withColumnRenamed("node", "fp"), "fp")
    least = named.groupBy("root").agg(F.min("least").alias("c_least"), F.min("rank").alias("c_rank"),
                                      F.min_by("row", F.col("rank")).alias("c_row"))
    linked = save(named.join(least, "root").select("fp", "c_least", "c_row"), "linked")
    groups = (distinct.join(linked, "fp", "left")
              .select("fp", F.when(F.col("c_row").isNull(), F.col("least")).otherwise(F.col("c_least")).alias("component_id"),
                      F.coalesce("c_row", "row").alias("winner")))
    return rows.join(groups, "fp").select("doc_id", "row_key", "fp", "component_id",
                                          (F.col("row_key") == F.col("winner")).alias("stays"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near copies; same columns."""
    docs = as_table(docs)
    return without(docs, near_groups(docs).filter(~F.col("stays")))


def op2_simhash(spark, sf_dir) -> DataFrame:
    g = near_groups(read(spark, sf_dir, "documents"))
    return g.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
