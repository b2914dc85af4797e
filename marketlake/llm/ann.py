"""Approximate nearest neighbours by multi-index hashing.

Vectors get ``BITS`` binary codes from rotations learned on a bounded sample
(iterative quantization).  Codes are split into 16-bit substrings, and each
block of rows has one directory per substring.  By the pigeonhole principle a
code within the Hamming radius agrees with the query's in some substring up to
its share of the radius, so probing every value that near in every directory
retrieves all codes within the radius; these are ranked by exact distance.  If
a block has fewer codes than asked for within the radius, the radius grows
there until it has.

Rows are dealt to blocks by a hash of vec_id, about ``BLOCK_ROWS`` each; the
query set is stated (and itself cut into blocks), and every pair of a query
block and a row block is one group's work with bounded memory.  Each pair
passes on k rows per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import read

K = 10
BITS = 128
SUBSTRING = 16
SAMPLE = 10_000                                     # rows the rotations and the radius are learned from
SAMPLE_QUERIES = 500
TARGET = 0.98                                       # share of the sample's true neighbours within the radius
BLOCK_ROWS = 8192
QUERY_ROWS = 4096
ROUNDS = 25
FOUND_DDL = "query_id bigint, vec_id bigint, score double"
_POPULATION = np.bitwise_count(np.arange(1 << SUBSTRING, dtype=np.uint32)).astype(np.uint8)
_NEAR = np.argsort(_POPULATION, kind="stable").astype(np.uint16)      # values by number of set bits
_UP_TO = np.searchsorted(_POPULATION[_NEAR], np.arange(SUBSTRING + 1), side="right")


class Codes:
    """Learned rotations: bit = (vector - mean) @ rotation > 0."""

    def __init__(self, mean: np.ndarray, rotation: np.ndarray, radius: int = 0):
        self.mean, self.rotation, self.radius = mean, rotation, radius

    @classmethod
    def learn(cls, x: np.ndarray, bits: int = BITS, seed: int = 11) -> Codes:
        """Iterative quantization: rotate so that signs lose least, from several random starts."""
        rng, mean = np.random.default_rng(seed), x.mean(axis=0)
        axes = np.linalg.eigh((x - mean).T @ (x - mean))[1][:, ::-1][:, :bits]    # principal axes, widest first
        v, parts = (x - mean) @ axes, []
        while sum(p.shape[1] for p in parts) < bits:
            r = np.linalg.qr(rng.normal(size=(v.shape[1], v.shape[1])))[0]
            for _ in range(ROUNDS):
                u, _, wt = np.linalg.svd(v.T @ np.sign(v @ r))
                r = u @ wt
            parts.append(axes @ r)
        return cls(mean, np.hstack(parts)[:, :bits])

    def of(self, x: np.ndarray) -> np.ndarray:
        """(rows, substrings) of unsigned 16-bit values."""
        bits = (x - self.mean) @ self.rotation > 0
        return np.packbits(bits, axis=1).view(np.uint16)

    def choose_radius(self, x: np.ndarray, k: int, target: float = TARGET) -> int:
        """Least radius that holds ``target`` of the k nearest of the first rows of ``x``."""
        codes, inside = self.of(x), np.zeros(BITS + 1)
        for i in range(min(SAMPLE_QUERIES, len(x))):
            d = ((x - x[i]) ** 2).sum(axis=1)
            d[i] = np.inf
            nearest = np.argsort(d)[:min(k, len(x) - 1)]
            inside += np.bincount(hamming(codes[nearest], codes[i]), minlength=BITS + 1)
        if not inside.sum():
            return 0
        return int(np.searchsorted(np.cumsum(inside), target * inside.sum()))


def hamming(codes: np.ndarray, one: np.ndarray) -> np.ndarray:
    return _POPULATION[codes ^ one].sum(axis=1, dtype=np.int64)


class Directories:
    """One bucket directory per substring of a block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(c, kind="stable") for c in codes.T]
        self.first = [np.searchsorted(c[o], np.arange((1 << SUBSTRING) + 1)) for c, o in zip(codes.T, self.order)]

    def within(self, one: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes differ from ``one`` in at most ``radius`` bits."""
        parts = self.codes.shape[1]
        share, rest = divmod(radius, parts)
        hit = np.zeros(len(self.codes), bool)
        for j in range(parts):
            own = share if j <= rest else share - 1   # all above these: more than radius bits in total
            if own < 0:
                continue
            probes = _NEAR[:_UP_TO[min(own, SUBSTRING)]] ^ one[j]
            start = self.first[j][probes]
            size = self.first[j][probes.astype(np.int64) + 1] - start
            start, size = start[size > 0], size[size > 0]
            at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
            hit[self.order[j][at]] = True
        rows = np.flatnonzero(hit)
        return rows[hamming(self.codes[rows], one) <= radius]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(rows), -1)


def _unique(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row per id: of different vectors under one id the smallest counts."""
    order = np.lexsort((*x.T[::-1], ids))
    ids, x = ids[order], x[order]
    first = np.concatenate([[True], ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, bool)
    return ids[first], x[first]


def search_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
                 codes: Codes, k: int) -> list[tuple[int, int, float]]:
    """(query, row, distance) of the k best rows of this block for each query."""
    own = codes.of(x)
    index, asked, found = Directories(own), codes.of(queries), []
    for q in range(len(query_ids)):
        others = ids != query_ids[q]
        want = min(k, int(others.sum()))
        rows = index.within(asked[q], codes.radius)
        rows = rows[others[rows]]
        if len(rows) < want:                          # widen until there are enough
            far = hamming(own, asked[q])
            least = np.partition(far[others], want - 1)[want - 1]
            rows = np.flatnonzero((far <= max(least, codes.radius)) & others)
        d = np.sqrt(((x[rows] - queries[q]) ** 2).sum(axis=1))
        best = np.lexsort((ids[rows], d))[:k]
        found += [(int(query_ids[q]), int(ids[rows[b]]), float(d[b])) for b in best]
    return found


def usable(vector: str) -> Column:
    """Not null or empty, no null or non-finite component, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda c: c != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, k: int = K, block_rows: int = BLOCK_ROWS,
            query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row that ``is_query`` marks.

    ``vectors`` has vec_id and embedding.  Nearness is the Euclidean distance
    in double precision, ties go to the smaller vec_id, and a query is no
    candidate of its own.  Rows with a null id or an unusable vector (see
    ``usable``) take no part, nor do vectors of another length than the most
    common one.  Rows that repeat an id count once.  An empty table, or one
    without queries, gives no rows.
    """
    rows = (vectors.filter(usable("embedding") & F.col("vec_id").isNotNull())
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("v"),
                    F.coalesce(is_query, F.lit(False)).alias("asks")))
    sizes = (rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q"))
             .orderBy(F.desc("n"), "d").first())
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.filter(F.size("v") == sizes["d"])
    sample = _matrix(rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()["v"])
    codes = Codes.learn(sample)
    codes.radius = codes.choose_radius(sample, k)
    blocks, askers = max(1, -(-sizes["n"] // block_rows)), max(1, -(-sizes["q"] // query_rows))

    def copies(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    asker = F.pmod(F.xxhash64(F.lit("asks"), "vec_id"), F.lit(askers)).cast("int")
    base = rows.select("vec_id", "v", block.alias("block"), copies(askers).alias("asker"))
    asking = rows.filter("asks").select("vec_id", "v", asker.alias("asker"), copies(blocks).alias("block"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            ids, x = _unique(left["vec_id"].to_numpy(), _matrix(left["v"]))
            query_ids, queries = _unique(right["vec_id"].to_numpy(), _matrix(right["v"]))
            found = search_block(ids, x, query_ids, queries, codes, k)
        cols = list(zip(*found)) if found else [[], [], []]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})

    found = (base.groupBy("block", "asker").cogroup(asking.groupBy("block", "asker"))
             .applyInArrow(lambda left, right: search(left, right), FOUND_DDL))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_nearest_neighbours(spark, sf_dir) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
