"""Phrase collocations by the stripes pattern.

A stripe belongs to a prefix (a language and 0 to 3 words) and counts the words
that come next.  Map tasks build one stripe per prefix and group of texts; the
shuffle brings the stripes of a prefix together, and they are added elementwise
in one stream of sorted rows.  A merged stripe gives the prefix's extensions
(its entries), its total and, as the largest entry, what may subsume the prefix.

The corpus is read three times: the empty prefix (words), one word (pairs) and
longer prefixes.  A phrase seen ``least`` times holds only phrases seen that
often, so each pass counts at places where the shorter ones passed.  What passed
is known to the tasks as a Bloom filter, sized by the number of phrases in it
and of at most 2**MOST_BITS bits; a wrongly passed place is counted and then
dropped for its count, so any filter gives the same result.

The stripes of the empty prefix, and of prefixes that begin with a hot word,
are cut into SLICES by a hash of the next word.  Hot are words that make up a
1/HOT_SHARE of the corpus or more, so there are at most HOT_SHARE of them.  No
task holds more than one slice and one batch of rows.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import read, save, text_or_empty

LEAST = 30
LONGEST = 4
TOP = 2000
SUBSUMED_PERCENT = 80
SCALE = 2_000_000
SLICES = 256
HOT_SHARE = 10_000
MOST_BITS = 27                                    # the filter has 16 MB at most
GROUP = 8 << 20                                   # bytes of texts counted together
BLANKS, SEPARATORS = b" \t", b".,;:!?\n\x0b\x0c\r"
KIND = np.zeros(256, np.uint8)                    # 0 word, 1 blank, 2 separator
KIND[list(BLANKS)], KIND[list(SEPARATORS)] = 1, 2
PLAIN = bytes(c + 32 if 65 <= c <= 90 else 32 if KIND[c] else c for c in range(256))
FACTORS = np.random.default_rng(11).integers(1 << 62, (1 << 63) - 1, LONGEST + 2).astype(np.uint64) | np.uint64(1)
STRIPES = "key string, entries string"            # slice, prefix, language by tabs; next word and count in turn by spaces
MERGED = "lang string, prefix string, slice int, total bigint, next array<string>, n array<bigint>"


def numbered_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(number of each word, its piece, the words by number) of lower-cased texts; no piece spans two texts."""
    raw = b"\n".join(t.encode() for t in texts)
    kind = KIND[np.frombuffer(raw, np.uint8)]
    edge = np.diff(np.r_[True, kind > 0, True].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
    raw = raw.translate(PLAIN)
    number = defaultdict(count().__next__)
    words = np.empty(len(starts), np.int64)
    for lo in range(0, len(starts), 1 << 19):     # split a bounded part at a time
        hi = min(len(starts), lo + (1 << 19))
        words[lo:hi] = np.fromiter(map(number.__getitem__, raw[starts[lo]:ends[hi - 1]].split()), np.int64, hi - lo)
    return words, piece, list(number)


def _hash(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest
    return np.array([xxh3_64_intdigest(w) for w in words], np.uint64)


def _positions(lang: str, hashes: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Filter positions of phrases, given the hashes of their first, second ... words."""
    key = np.full(len(hashes[0]), _hash([lang.encode()])[0])
    for h, factor in zip(hashes, FACTORS):
        key += h * factor
    key ^= key >> np.uint64(31)
    return [(key * factor) >> np.uint64(64 - bits) for factor in FACTORS[-2:]]


class PhraseFilter:
    """A Bloom filter of phrases, as 64-bit words; it may pass others too."""

    def __init__(self, table: np.ndarray, bits: int):
        self.table, self.bits = table, bits

    def __call__(self, lang: str, hashes: list[np.ndarray]) -> np.ndarray:
        passed = np.ones(len(hashes[0]), bool)
        for p in _positions(lang, hashes, self.bits):
            passed &= (self.table[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) > 0
        return passed

    @classmethod
    def of(cls, phrases: DataFrame) -> PhraseFilter:
        """The filter of (lang, phrase); only its 64-bit words come to the driver."""
        bits = min(MOST_BITS, max(16, (16 * phrases.count()).bit_length()))

        def slots(batches):
            for b in batches:
                langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                by = defaultdict(list)
                for lang, text in zip(langs, texts):
                    parts = text.encode().split(b" ")
                    by[lang, len(parts)].append(parts)
                for (lang, _), parts in by.items():
                    for p in _positions(lang, [_hash(list(w)) for w in zip(*parts)], bits):
                        at = (p >> np.uint64(6)).astype(np.int64)
                        bit = (np.uint64(1) << (p & np.uint64(63))).view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bit)], names=["at", "bit"])

        found = (phrases.select("lang", "phrase").mapInArrow(slots, "at bigint, bit bigint")
                 .groupBy("at").agg(F.bit_or("bit").alias("bit"))).toArrow()
        table = np.zeros(max(1, (1 << bits) >> 6), np.uint64)
        table[found["at"].to_numpy()] = found["bit"].to_numpy().view(np.uint64)
        return cls(table, bits)


def _stripes(lang: str, prefixes: pa.Array, which: np.ndarray, nexts: np.ndarray, n: np.ndarray,
             words: pa.Array, slices: np.ndarray) -> pa.RecordBatch:
    """One row per (prefix, slice): entry i counts word ``nexts[i]`` after prefix ``which[i]`` n[i] times."""
    order = np.lexsort((slices, which))
    which, nexts, n, slices = which[order], nexts[order], n[order], slices[order]
    new = np.flatnonzero(np.r_[True, (np.diff(which) != 0) | (np.diff(slices) != 0)]) if len(which) else np.array([], int)
    key = pc.binary_join_element_wise(pa.array(slices[new], pa.int32()).cast(pa.string()),
                                      prefixes.take(pa.array(which[new])), pa.scalar(lang), "\t")
    entry = pc.binary_join_element_wise(words.take(pa.array(nexts)), pa.array(n, pa.int64()).cast(pa.string()), " ")
    offsets = pa.array(np.r_[new, len(which)], pa.int32())
    return pa.RecordBatch.from_arrays([key, pc.binary_join(pa.ListArray.from_arrays(offsets, entry), " ")],
                                      names=["key", "entries"])


def _group_stripes(lang: str, texts: list[str], orders: range, passed: PhraseFilter | None, hot: set):
    """The stripes of one language's texts for prefixes of the given numbers of words."""
    words, piece, names = numbered_words(texts)
    if not len(words):
        return
    size, hashes = len(names), _hash(names)
    table = pa.array(names, pa.binary()).cast(pa.string())
    spread = (hashes % np.uint64(SLICES)).astype(np.int32)
    if orders[0] == 0:
        n = np.bincount(words, minlength=size)
        every = np.arange(size)
        yield _stripes(lang, pa.array([""]), np.zeros(size, np.int64), every, n, table, spread)
        return
    is_hot = np.array([(lang, w) in hot for w in names])
    joined = piece[1:] == piece[:-1]
    if orders[0] == 1:
        frequent = passed(lang, [hashes])
        good = joined & frequent[words[1:]] & frequent[words[:-1]]
    else:
        good = joined.copy()
        at = np.flatnonzero(joined)
        good[at] = passed(lang, [hashes[words[at]], hashes[words[at + 1]]])
    at, prefix = np.arange(len(words)), words     # places whose phrase so far passed, and that phrase's number
    prefixes, hot_prefix = table, is_hot
    for k in range(1, orders[-1] + 1):
        open_ = at + k < len(words)
        at, prefix = at[open_], prefix[open_]
        on = good[at + k - 1]
        at, prefix = at[on], prefix[on]
        phrases, phrase, n = np.unique(prefix * size + words[at + k], return_inverse=True, return_counts=True)
        which, nexts = phrases // size, phrases % size
        if k in orders and len(phrases):
            slices = np.where(hot_prefix[which], spread[nexts], 0)
            yield _stripes(lang, prefixes, which, nexts, n, table, slices)
        if k < orders[-1]:
            prefixes = pc.binary_join_element_wise(prefixes.take(pa.array(which)), table.take(pa.array(nexts)), " ")
            hot_prefix, prefix = hot_prefix[which], phrase.reshape(-1)


def _merge(batches, least: int):
    """Add up stripes sorted by key: per stripe its total and the entries counted at least ``least`` times."""
    def rows(keys, entries, totals):
        """One output row per key; entries (g, next, n) belong to the key numbered g."""
        frequent = entries.filter(pc.greater_equal(entries["n"], least)).sort_by("g")
        sizes = np.bincount(frequent["g"].to_numpy(), minlength=len(keys))
        offsets = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
        parts = pc.list_flatten(pc.split_pattern(keys, "\t", max_splits=2))
        number, prefix, lang = (parts.take(pa.array(np.arange(i, 3 * len(keys), 3))) for i in range(3))
        flat = lambda c: frequent[c].combine_chunks()
        return pa.RecordBatch.from_arrays(
            [lang, prefix, number.cast(pa.int32()), pa.array(totals),
             pa.ListArray.from_arrays(offsets, flat("next")), pa.ListArray.from_arrays(offsets, flat("n"))],
            names=["lang", "prefix", "slice", "total", "next", "n"])

    key = held = None                             # the last stripe seen may go on in the next batch
    for b in batches:
        if not b.num_rows:
            continue
        keys, lists = b.column(0), pc.split_pattern(b.column(1), " ")
        row = np.repeat(np.arange(b.num_rows), pc.list_value_length(lists).to_numpy() // 2)
        flat = pc.list_flatten(lists)
        nexts = flat.take(pa.array(np.arange(0, len(flat), 2)))
        n = flat.take(pa.array(np.arange(1, len(flat), 2))).cast(pa.int64())
        if key is not None:
            keys, row = pa.concat_arrays([key, keys]), np.r_[np.zeros(held.num_rows, np.int64), row + 1]
            nexts, n = pa.concat_arrays([held["next"].combine_chunks(), nexts]), pa.concat_arrays([held["n"].combine_chunks(), n])
        new = np.r_[True, pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)]
        group = np.cumsum(new) - 1
        entries = pa.table({"g": group[row], "next": nexts, "n": n}).group_by(
            ["g", "next"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["g", "next", "n"])
        firsts, last = np.flatnonzero(new), int(group[-1])
        if last:
            done = entries.filter(pc.less(entries["g"], last))
            totals = np.zeros(last, np.int64)
            np.add.at(totals, done["g"].to_numpy(), done["n"].to_numpy())
            yield rows(keys.take(pa.array(firsts[:-1])), done, totals)
        key, held = keys.slice(int(firsts[-1]), 1), entries.filter(pc.equal(entries["g"], last)).select(["next", "n"])
    if key is not None:
        entries = held.append_column("g", pa.array(np.zeros(held.num_rows, np.int64)))
        yield rows(key, entries, np.array([pc.sum(held["n"]).as_py()], np.int64))


def merged_stripes(source: DataFrame, orders: range, least: int, passed: PhraseFilter | None = None,
                   hot: set = frozenset()) -> DataFrame:
    """The merged stripes of ``source`` (lang, text) for prefixes of ``orders`` words, as a written table."""
    shared = source.sparkSession.sparkContext.broadcast((passed, hot))

    def run(batches):
        known, hot_words = shared.value
        for b in batches:
            by, size = defaultdict(list), defaultdict(int)
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                by[lang].append(text.as_py())
                size[lang] += len(by[lang][-1]) + 1
                if size[lang] >= GROUP:
                    yield from _group_stripes(lang, by.pop(lang), orders, known, hot_words)
                    size[lang] = 0
            for lang, texts in by.items():
                yield from _group_stripes(lang, texts, orders, known, hot_words)

    stripes = source.mapInArrow(run, STRIPES).repartition("key").sortWithinPartitions("key")
    return save(stripes.mapInArrow(lambda batches: _merge(batches, least), MERGED), f"stripes-{orders[0]}")


def _phrases(stripes: DataFrame) -> DataFrame:
    """(lang, prefix, phrase, a): the entries of merged stripes."""
    e = stripes.select("lang", "prefix", F.explode(F.arrays_zip("next", "n")).alias("e"))
    return e.select("lang", "prefix", F.concat(F.when(F.col("prefix") != "", F.concat("prefix", F.lit(" ")))
                                               .otherwise(""), F.col("e.next")).alias("phrase"),
                    F.col("e.n").alias("a"))


def _with_count(rows: DataFrame, part: str, counts: DataFrame, hot: DataFrame, name: str) -> DataFrame:
    """``rows`` with the count of the phrase in column ``part``.

    The parts that many rows share are few (``hot``, bounded): joined apart,
    Spark sends them to every task once it has measured them as small, or
    splits their keys' tasks (AQE) if not.
    """
    def renamed(c):
        return c.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias(name))

    same = (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_phrase"))
    few = renamed(hot)
    return (rows.join(few, same).unionByName(rows.join(few, same, "left_anti").join(renamed(counts), same))
            .drop("_lang", "_phrase"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, text: str = "text", lang: str = "lang",
                 scale: int = SCALE, subsumed_percent: int = SUBSUMED_PERCENT) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases are 2 to 4 words of one piece that occur at least ``least`` times
    (a).  The score is the least over all cuts of ``scale`` * a // (l + r), l
    and r counting the two parts; phrases that lie in a longer one with
    ``subsumed_percent`` of their count are dropped.  n counts all words of the
    language.  A null language is ``und``, a null text has no words; repeated
    rows count again; ties in score and a go by the phrase's bytes; an empty
    table gives no rows; other columns are not read.
    """
    source = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("l"),
                         text_or_empty(text).alias("t"))
    words = merged_stripes(source, range(0, 1), least)
    totals = save(words.groupBy("lang").agg(F.sum("total").alias("n")), "words-in-all")
    hot_from = max(1, (totals.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE)
    found = [save(_phrases(words), "phrases-1")]
    hot = {(r["lang"], r["phrase"].encode())                         # at most HOT_SHARE rows
           for r in found[0].filter(F.col("a") >= hot_from).toLocalIterator()}
    pairs = merged_stripes(source, range(1, 2), least, PhraseFilter.of(found[0]), hot)
    found.append(save(_phrases(pairs), "phrases-2"))
    longer = merged_stripes(source, range(2, LONGEST), least, PhraseFilter.of(found[1]), hot)
    found.append(save(_phrases(longer), "phrases-long"))

    candidates = found[1].unionByName(found[2])
    counts = found[0].unionByName(candidates).select("lang", "phrase", F.col("a").alias("f"))
    few = counts.filter(F.col("f") >= hot_from)                      # at most LONGEST * HOT_SHARE rows
    after = F.substring_index("phrase", " ", -1)
    rest = F.expr("substr(phrase, length(substring_index(phrase, ' ', 1)) + 2)")
    # a stripe's largest entry subsumes its prefix; the same entries by their last words subsume those
    grown = found[2].select("lang", F.explode(F.array("prefix", rest)).alias("phrase"), "a")
    largest = grown.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    wide = F.lit(0).cast("decimal(20,0)")
    kept = (candidates.join(largest, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull()
                    | ((F.col("longer") + wide) * 100 < (F.col("a") + wide) * subsumed_percent)))
    kept = save(kept.select("lang", "phrase", "a", F.split("phrase", " ").alias("w")), "phrases-kept")
    cuts = kept.select("lang", "phrase", "a", F.posexplode(F.expr(
        "transform(sequence(1, size(w) - 1), k -> struct(array_join(slice(w, 1, k), ' ') AS head, "
        "array_join(slice(w, k + 1, size(w) - k), ' ') AS tail))")).alias("k", "part"))
    cuts = cuts.select("lang", "phrase", "a", "k", "part.head", "part.tail")
    both = _with_count(save(_with_count(save(cuts, "phrase-cuts"), "head", counts, few, "l"), "phrase-heads"),
                       "tail", counts, few, "r")
    # at most 2000000 times a 63-bit count: exact in 38 digits
    score = F.expr(f"(CAST({int(scale)} AS DECIMAL(18,0)) * CAST(a AS DECIMAL(20,0))) "
                   "div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))").cast("bigint")
    scored = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = (scored.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
            .withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r",
                                            "n", "score")


def op13_phrases(spark, sf_dir) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\n\x0B\f\r]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM p),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
      FROM w, (VALUES (1), (2), (3), (4)) AS o(k) WHERE len(w) >= k),
f AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS a FROM g GROUP BY 1, 2, 3),
c AS (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 30),
inner_ AS (SELECT lang, unnest([array_to_string(w[i:i + m - 1], ' ') for i in generate_series(1, k - m + 1)]) AS phrase, a
           FROM c, (VALUES (2), (3)) AS o(m) WHERE m < k),
longest AS (SELECT lang, phrase, max(a) AS longer FROM inner_ GROUP BY 1, 2),
kept AS (SELECT c.* FROM c LEFT JOIN longest USING (lang, phrase)
         WHERE longer IS NULL OR NOT 100 * longer::HUGEINT >= 80 * a::HUGEINT),
cut AS (SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS tail
        FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM kept)),
s AS (SELECT cut.*, h.a AS l, t.a AS r, ((2000000 * cut.a::HUGEINT) // (h.a::HUGEINT + t.a::HUGEINT))::BIGINT AS score
      FROM cut JOIN f h ON h.lang = cut.lang AND h.phrase = cut.head JOIN f t ON t.lang = cut.lang AND t.phrase = cut.tail),
one AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM one JOIN total USING (lang)
QUALIFY rank <= 2000
"""
