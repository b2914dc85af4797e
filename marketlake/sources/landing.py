"""Landed files as numbered batches, found without listing the history (STR-1, SRC-1).

A file stream lists its whole tree on every trigger.  Landing folders are named
by the time of landing, so new files turn up only in the newest folders of an
asset: ``Landing`` remembers per asset its ``open_folders`` newest folders and
the files it has seen in them, and lists only those, the levels above them and
what sorts behind.  The number of listings per trigger follows the number of
assets and of new folders, not the age of the lake.

A batch is planned by a record (put if absent, like a version of a lake) before
anything is read, and marked done when it is handled: a restart repeats exactly
the batch that was not done, with the same files, and goes on behind it.  A file
that lands in a folder that is open no more is not found; a dated batch run
merges such a day (``plans.pipeline.run_batch``).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.schemas import BRONZE, CORRUPT
from marketlake.sinks.lake import _fs, _read_text, _write_text, put_if_absent
from marketlake.sources.bronze import with_path_partitions

#: Levels of folders under an asset's: YYYY/MM/DD/HH.
EXCHANGE_LEVELS = 4
LISTERS = 32


def _order(name: str) -> tuple[int, str]:
    """Folder names of a level in time order: ``hour=9`` before ``hour=10``, ``09`` before ``10``."""
    return len(name), name


@dataclass(frozen=True)
class Batch:
    number: int
    files: tuple[str, ...]


class Landing:
    """The files of a landing tree ``{source}/{asset}/<levels>/`` in batches; ``state`` holds the records."""

    def __init__(self, spark: SparkSession, source: str, state: str, levels: int = EXCHANGE_LEVELS,
                 open_folders: int = 2, max_files: int | None = None):
        self.spark, self.source, self.state = spark, source.rstrip("/"), state.rstrip("/")
        self.levels, self.open_folders, self.max_files = levels, open_folders, max_files
        self.listed = 0                                              # folders listed by the last plan
        p, fs = _fs(spark, self.state)
        fs.mkdirs(p)

    def _record(self, number: int, done: bool = False) -> str:
        return f"{self.state}/{number:020d}{'.done' if done else '.json'}"

    def _newest(self) -> tuple[int, dict]:
        """The last planned batch and what is open behind it: (asset -> folder -> files seen)."""
        number = int(_read_text(self.spark, f"{self.state}/_newest") or 0)
        text = _read_text(self.spark, self._record(number)) if number else None
        while (later := _read_text(self.spark, self._record(number + 1))) is not None:
            number, text = number + 1, later
        return number, json.loads(text) if text else {"files": [], "open": {}}

    def _list(self, folder: str) -> tuple[list[str], list[str]]:
        """(names of folders in time order, names of files) of a folder; hidden ones are left out."""
        p, fs = _fs(self.spark, folder)
        self.listed += 1
        found = [(s.isDirectory(), s.getPath().getName()) for s in fs.listStatus(p)] if fs.exists(p) else []
        seen = [(d, n) for d, n in found if not n.startswith(("_", "."))]
        return sorted((n for d, n in seen if d), key=_order), sorted(n for d, n in seen if not d)

    def _from(self, asset: str, oldest: list[str]) -> list[str]:
        """Leaf folders of an asset from the path ``oldest`` on, in time order; only levels on its way are listed."""
        paths = [([], True)]                                         # (names, whether still on the way of ``oldest``)
        for level in range(self.levels):
            below = []
            for names, on_way in paths:
                for n in self._list("/".join([self.source, asset, *names]))[0]:
                    limit = oldest[level] if on_way and oldest else None
                    if limit is None or _order(n) >= _order(limit):
                        below.append(([*names, n], limit is not None and n == limit))
            paths = below
        return ["/".join(names) for names, _ in paths]

    def _new(self, asset: str, seen: dict[str, list[str]]) -> list[tuple[str, str]]:
        """(folder, file) of the asset that no batch has, in time order."""
        oldest = min(seen, key=lambda f: [_order(n) for n in f.split("/")]).split("/") if seen else []
        return [(folder, name) for folder in self._from(asset, oldest)
                for name in self._list(f"{self.source}/{asset}/{folder}")[1] if name not in set(seen.get(folder, ()))]

    def plan(self) -> Batch | None:
        """The batch to handle now: the one that was not done, or a new one; None if nothing has landed."""
        self.listed = 0
        number, newest = self._newest()
        if number and _read_text(self.spark, self._record(number, done=True)) is None:
            return Batch(number, tuple(newest["files"]))
        assets = self._list(self.source)[0]
        with ThreadPoolExecutor(LISTERS) as pool:
            new = list(pool.map(lambda a: self._new(a, newest["open"].get(a, {})), assets))
        files = [(a, folder, name) for a, own in zip(assets, new) for folder, name in own]
        if not files:
            return None
        files.sort(key=lambda x: ([_order(n) for n in x[1].split("/")], x))
        files = files[:self.max_files]                               # the rest waits, still unseen
        open_ = {a: {f: list(names) for f, names in folders.items()} for a, folders in newest["open"].items()}
        for a, folder, name in files:
            open_.setdefault(a, {}).setdefault(folder, []).append(name)
        for folders in open_.values():                               # files go in time order: what sorts before is all seen
            for old in sorted(folders, key=lambda f: [_order(n) for n in f.split("/")])[:-self.open_folders]:
                del folders[old]
        record = {"files": [f"{self.source}/{a}/{folder}/{name}" for a, folder, name in files], "open": open_}
        if not put_if_absent(self.spark, self._record(number + 1), json.dumps(record)):
            raise RuntimeError(f"another reader planned batch {number + 1} of {self.state}")
        return Batch(number + 1, tuple(record["files"]))

    def done(self, batch: Batch) -> None:
        put_if_absent(self.spark, self._record(batch.number, done=True), "")
        _write_text(self.spark, f"{self.state}/_newest", str(batch.number))

    def read(self, batch: Batch, multiline: bool = True) -> DataFrame:
        """The batch's envelopes, as ``read_bronze`` gives them."""
        df = (self.spark.read.schema(BRONZE).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("multiline", multiline).json(list(batch.files)))
        return with_path_partitions(df.withColumn("_file", F.col("_metadata.file_path")), "_file")


def drain(landing: Landing, handle: Callable[[DataFrame, int], None], multiline: bool = True,
          columns: Sequence[str] | None = None) -> int:
    """Handle batches until nothing new has landed; returns how many.  ``handle`` may see its last batch again."""
    n = 0
    while (batch := landing.plan()) is not None:
        df = landing.read(batch, multiline)
        handle(df.select(*columns) if columns else df, batch.number)
        landing.done(batch)
        n += 1
    return n
