"""Best-fit packing of token sequences.

``pack`` tokenizes every text, cuts only documents above ``capacity`` and
places the pieces with a bounded-space online best-fit: a fixed number of open
bins, kept in a bitset keyed by free space.  A piece goes to the open bin with
the least free space that still holds it; when no bin holds it and all are
open, the fullest bin closes.  The pieces of one batch of rows (about a million
characters, less than the open bins hold) are handed to it longest first, which
leaves short ones to fill the gaps.  Each task packs the rows of its own input
partition while it reads them, so nothing is shuffled and a task holds only the
open bins' free space, one batch and a word cache of bounded size.  A lost task
is repeated on the same rows in the same order and gives the same bins.

White space is dropped by the tokenizer and always ends a token, so a text's
ids are the ids of its white-space separated words in a row; each distinct
word is encoded once per cache life.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator
from types import ModuleType

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import read, text_or_empty

CAPACITY = 2048
OPEN_BINS = 256
CACHE_WORDS = 600_000                              # about 150 MB
#: letters (A-Z, a-z, Latin-1), then ASCII punctuation, and nothing that a control string may start
PLAIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-/:;=->@[-`{-~]*)")
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids", pa.binary()), ("sequence_id", pa.int64()),
                    ("offset", pa.int64())])
PIECES_DDL = ("doc_id bigint, piece int, start bigint, length bigint, ids binary, "
              "sequence_id bigint, offset bigint")


class BestFit:
    """Online best-fit over at most ``open_bins`` bins; ``place`` gives (bin, offset)."""

    def __init__(self, capacity: int, open_bins: int, first_bin: int = 0):
        self.capacity, self.open_bins, self.next_bin = capacity, open_bins, first_bin
        self.bits, self.n = 0, 0                               # bit f: some open bin has f free
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bin_ = self.at[free].pop()
        if not self.at[free]:
            self.bits &= ~(1 << free)
        self.n -= 1
        return bin_

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
        else:
            free, bin_ = self.capacity, self.next_bin
            self.next_bin += 1
        if left := free - length:
            if self.n == self.open_bins:
                fullest = (self.bits & -self.bits).bit_length() - 1
                if fullest > left:                             # this bin is the fullest: it closes
                    return bin_, self.capacity - free
                self._take(fullest)
            self.at[left].append(bin_)
            self.bits |= 1 << left
            self.n += 1
        return bin_, self.capacity - free


class WordEncoder(dict):
    """Word (bytes) -> its ids as little-endian 32-bit integers; a bounded cache that fills itself.

    The tokenizer always cuts between a run of letters and the punctuation
    behind it, and ignores case, so a word of that form is looked up as those
    two parts.  Words with digits, control strings or other characters are
    encoded whole.
    """

    def __init__(self, vocabulary: str, cache_words: int = CACHE_WORDS):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenize = self.tokenizer.model.tokenize
        self.plain = Tokenizer.from_file(vocabulary)          # for lower-case parts: nothing to normalise or split
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.parts: dict[str, bytes] = {"": b""}
        self.limit = cache_words

    @classmethod
    def of_worker(cls, vocabulary: str) -> WordEncoder:
        """The encoder of this Python worker, kept from task to task."""
        held = sys.modules.setdefault("_marketlake_encoders", ModuleType("_marketlake_encoders"))
        if vocabulary not in vars(held):
            setattr(held, vocabulary, cls(vocabulary))
        return vars(held)[vocabulary]

    def _part(self, part: str) -> bytes:
        if part.isascii():                                    # bytes and their symbols are the same here
            ids = [t.id for t in self.tokenize(part)]
        else:
            ids = self.plain.encode(part, add_special_tokens=False).ids
        self.parts[part] = out = array("I", ids).tobytes()
        return out

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        m = PLAIN_WORD.fullmatch(text)
        if m:
            letters, marks = m.groups()
            letters = letters.lower()
            head, tail = self.parts.get(letters), self.parts.get(marks)
            out = ((self._part(letters) if head is None else head)
                   + (self._part(marks) if tail is None else tail))
        else:
            out = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self[word] = out
        return out

    def encode(self, text: str) -> bytes:
        if len(self) > self.limit:
            self.clear()
            self.parts = {"": b""}
        return b"".join(map(self.__getitem__, text.encode().split()))


def _batches(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``most`` characters together."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
         open_bins: int = OPEN_BINS, end_id: int = 0, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids, sequence_id, offset) of all rows of ``docs``.

    ``ids`` holds the piece's token ids as little-endian 32-bit integers.  A
    null or empty text is the single ``end_id``; a null id stays null; a
    repeated row is packed as often as it is there; an empty table gives no
    rows.  Columns other than the two named are not read.  ``sequence_id`` is
    the input partition in the upper bits and a counter in the lower ones.
    """
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("word_bpe_49k.json")

    def run(batches):
        part = TaskContext.get().partitionId()
        encoder, bins = None, BestFit(capacity, open_bins, part << 40)
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            encoder = encoder or WordEncoder.of_worker(vocabulary)
            ids_, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in _batches(texts):
                cols: tuple[list, ...] = ([], [], [], [], [])
                for d, raw in zip(ids_[lo:hi], map(encoder.encode, texts[lo:hi])):
                    raw += end
                    for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                        blob = raw[at:at + 4 * capacity]
                        for col, v in zip(cols, (d, piece, at >> 2, len(blob) >> 2, blob)):
                            col.append(v)
                lengths = cols[3]
                places: list = [None] * len(lengths)
                for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
                    places[i] = bins.place(lengths[i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip((*cols, *zip(*places)), PIECES)], schema=PIECES)

    source = docs.select(F.col(doc_id).cast("bigint").alias("d"), text_or_empty(text).alias("t"))
    return source.mapInArrow(run, PIECES_DDL)


def op1_best_fit_packing(spark, sf_dir) -> DataFrame:
    """All documents packed into 2048-token sequences, with the crc of each piece's ids."""
    p = pack(read(spark, sf_dir, "documents"))
    return p.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                    "sequence_id", "offset")
