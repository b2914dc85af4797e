"""Exact dedup through a minimal perfect hash over historical distinct digests.

``build_index`` reduces the historical rows to distinct digests (map-side
combine first), deals them to shards by a hash of the digest and builds one
minimal perfect hash per shard.  A slot holds the full 32-byte digest, the
winner's locator (doc_id and row key) and the number of copies.  ``probe``
reduces the new rows the same way and looks each digest up: a slot whose
digest is byte-equal is a repeat and joins that group; the rest, nonmembers,
form groups of their own.  Only digests move; a digest is in a shuffle once
per map task however many copies a text has, and a shard holds about
``SHARD_KEYS`` digests, historical and new ones together, whatever the input
size and the split.

Texts are equal when identical after lower-casing A-Z; null counts as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import as_table, crc_mod, read, save, text_or_empty, with_row_key, without

SHARD_KEYS = 32_768
LOAD = 2.0                                        # bits per key at each level
INDEX_DDL = "shard bigint, mph binary, digests binary, keep_id binary, keep_row binary, copies binary"
GROUP_DDL = "digest binary, keep_id bigint, keep_row bigint, group_size bigint, historical boolean"
NULL_ID = -(1 << 63)


class MinimalPerfectHash:
    """Levels of bitmaps: a key rests at the first level where it alone has its bit.

    Its slot is the number of set bits before that bit, over all levels; keys
    that still collide after ``max_levels`` are listed one by one behind them.
    """

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.before = np.cumsum([0] + [int(b.sum()) for b in levels])
        self.rank = [np.cumsum(b, dtype=np.int64) - b for b in levels]

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (keys[:, 0] + np.uint64(2 * level + 1) * keys[:, 1]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(32)
        return (x % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, max_levels: int = 40) -> MinimalPerfectHash:
        """``keys``: distinct rows of two unsigned 64-bit words."""
        levels, left = [], keys
        while len(left) and len(levels) < max_levels:
            size = max(8, int(LOAD * len(left)))
            at = cls._place(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels, left)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; a key that was not built in gets any slot, or -1."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = self._place(keys[todo], level, len(bits))
            hit = bits[at]
            out[todo[hit]] = self.before[level] + self.rank[level][at[hit]]
            todo = todo[~hit]
        for i, key in enumerate(self.rest):
            out[todo[(keys[todo] == key).all(axis=1)]] = self.before[-1] + i
        return out

    def dump(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], "<i8").tobytes()
        return head + b"".join(np.packbits(b).tobytes() for b in self.levels) + self.rest.tobytes()

    @classmethod
    def load(cls, raw: bytes) -> MinimalPerfectHash:
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        sizes, pos, levels = np.frombuffer(raw, "<i8", n, 8), 8 * (n + 1), []
        for s in sizes:
            width = -(-int(s) // 8)
            bits = np.unpackbits(np.frombuffer(raw, np.uint8, width, pos), count=int(s))
            levels.append(bits.astype(bool))
            pos += width
        return cls(levels, np.frombuffer(raw, "<u8", offset=pos).reshape(-1, 2))


def _digest_rows(table: pa.Table) -> np.ndarray:
    column = table.column("digest")
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _words(digests: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(digests[:, :16]).view("<u8").astype(np.uint64)


def _build_shard(table: pa.Table) -> pa.Table:
    digests = _digest_rows(table)
    mph = MinimalPerfectHash.build(_words(digests))
    order = np.argsort(mph.slots(_words(digests)))
    # a null winner id is stored as the smallest long, which no kept id equals after reading back
    cols = {c: np.array([NULL_ID if v is None else v for v in table.column(c).to_pylist()], "<i8")[order]
            for c in ("keep_id", "keep_row", "group_size")}
    return pa.table({"shard": [table.column("shard")[0].as_py()], "mph": [mph.dump()],
                     "digests": [digests[order].tobytes()],
                     "keep_id": [cols["keep_id"].tobytes()], "keep_row": [cols["keep_row"].tobytes()],
                     "copies": [cols["group_size"].tobytes()]})


def _probe_shard(index: pa.Table, batch: pa.Table) -> pa.Table:
    """Groups of one shard: historical ones, brought up to date by the repeats, and new ones."""
    n_new = batch.num_rows
    new = {c: np.array([NULL_ID if v is None else v for v in batch.column(c).to_pylist()], np.int64)
           for c in ("keep_id", "keep_row", "group_size")}
    new_digests = _digest_rows(batch) if n_new else np.empty((0, 32), np.uint8)
    member = np.zeros(n_new, bool)
    old = {"keep_id": np.empty(0, np.int64), "keep_row": np.empty(0, np.int64),
           "group_size": np.empty(0, np.int64)}
    slots_digests = np.empty((0, 32), np.uint8)
    if index.num_rows:
        row = index.to_pylist()[0]
        slots_digests = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        old = {k: np.frombuffer(row[c], "<i8").copy() for k, c in
               (("keep_id", "keep_id"), ("keep_row", "keep_row"), ("group_size", "copies"))}
        if n_new:
            slot = MinimalPerfectHash.load(row["mph"]).slots(_words(new_digests))
            near = slot >= 0
            member[near] = (slots_digests[slot[near]] == new_digests[near]).all(axis=1)
            at = slot[member]                      # each digest is once in the batch: no slot twice
            old["group_size"][at] += new["group_size"][member]
            later = new["keep_id"][member] > old["keep_id"][at]
            for c in ("keep_id", "keep_row"):
                old[c][at[later]] = new[c][member][later]
    fresh = ~member
    digests = np.concatenate([slots_digests, new_digests[fresh]])
    keep_id = np.concatenate([old["keep_id"], new["keep_id"][fresh]])
    return pa.table({
        "digest": pa.array([d.tobytes() for d in digests], pa.binary()),
        "keep_id": pa.array(keep_id, pa.int64(), mask=keep_id == NULL_ID),
        "keep_row": pa.array(np.concatenate([old["keep_row"], new["keep_row"][fresh]])),
        "group_size": pa.array(np.concatenate([old["group_size"], new["group_size"][fresh]])),
        "historical": pa.array(np.arange(len(digests)) < len(slots_digests))})


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row_key, digest): SHA-256 of every whole text after lower-casing A-Z."""
    def run(batches):
        from hashlib import sha256
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1),
                 pa.array([sha256(t.encode().lower()).digest() for t in b.column(2).to_pylist()],
                          pa.binary())], names=["doc_id", "row_key", "digest"])

    # bytes.lower() changes A-Z only, and no byte of a multi-byte character is in that range
    source = with_row_key(docs, columns={"d": F.col(doc_id).cast("bigint"), "t": text_or_empty(text)})
    return source.select("d", "_row_key", "t").mapInArrow(
        run, "doc_id bigint, row_key bigint, digest binary")


def distinct_digests(rows: DataFrame) -> DataFrame:
    """One row per digest: largest doc_id, that row's key, number of rows (combined map-side)."""
    rank = F.coalesce("doc_id", F.lit(NULL_ID))
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"),
                                      F.max_by("row_key", rank).alias("keep_row"),
                                      F.count(F.lit(1)).alias("group_size"))


def _sharded(groups: DataFrame, shards: int) -> DataFrame:
    return groups.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """The written index over ``history`` (rows of ``distinct_digests``)."""
    index = _sharded(history, shards).groupBy("shard").applyInArrow(_build_shard, INDEX_DDL)
    return save(index, "digest-index")


def probe(index: DataFrame, shards: int, batch: DataFrame) -> DataFrame:
    """All groups of history and ``batch`` (rows of ``distinct_digests``) together.

    (digest, keep_id, keep_row, group_size, historical)
    """
    new = _sharded(batch, shards)
    return (index.groupBy("shard").cogroup(new.groupBy("shard"))
            .applyInArrow(lambda old, rows: _probe_shard(old, rows), GROUP_DDL))


def exact_dedup(docs: DataFrame, historical=None, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, row_key, digest, keep_id, group_size, kept.

    ``historical`` is a condition on doc_id that marks the rows the index is
    built from; the others are looked up in it.  By default that is one half
    of the ids by hash.  The result is the same for every split.  The row with
    the largest doc_id stays; of repeated rows with that id exactly one does;
    a group whose ids are all null keeps one row and has a null keep_id.  An
    empty table gives no rows; other columns are not read.
    """
    rows = save(digests(docs, doc_id, text), "digests")
    old = historical if historical is not None else crc_mod("doc_id", 2) == 0
    old = F.coalesce(old, F.lit(False))
    history = save(distinct_digests(rows.filter(old)), "digest-history")
    batch = save(distinct_digests(rows.filter(~old)), "digest-batch")
    shards = max(1, -(-(history.count() + batch.count()) // SHARD_KEYS))
    groups = save(probe(build_index(history, shards), shards, batch), "digest-groups")
    return (rows.join(groups, "digest")
            .select("doc_id", "row_key", "digest", "keep_id", "group_size",
                    (F.col("row_key") == F.col("keep_row")).alias("kept")))


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; same columns."""
    docs = as_table(docs)
    return without(docs, exact_dedup(docs).filter(~F.col("kept")))


def op6_exact_dedup(spark, sf_dir) -> DataFrame:
    d = exact_dedup(read(spark, sf_dir, "documents"))
    return d.select("doc_id", "keep_id", "group_size", "kept",
                    F.lower(F.hex("digest")).alias("text_sha256"))


OP6_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM t
"""
