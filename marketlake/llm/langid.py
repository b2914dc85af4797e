"""Language identification with language-bitmask n-gram filters.

The n-grams (4 bytes of the lower-cased UTF-8 text, white space included) that
make up at least ``min_share`` of a language's training text go into a
bit-sliced Bloom filter: position p holds one bit per language, and the AND of
an n-gram's positions is the mask of all languages that contain it.  A text's
language is the one most of its n-grams belong to, each language's count
corrected by the false-positive rate its own fill causes.

Counting and the filter's positions are Spark aggregates over all training
rows.  The filter is sized from the counted n-grams of the largest language, so
that a foreign n-gram is taken for one of its own at a rate of at most
``FALSE_RATE``.  A language has at most 1 / min_share n-grams, which bounds the
filter (2**23 positions at the default); only it goes to the tasks.  An n-gram
that is rarer than ``min_share`` belongs to no language; a text loses at most
the share of such n-grams in it.  Scoring is one pass over the texts without a
shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import as_table, crc_mod, read, save, text_or_empty, with_row_key, without

GRAM = 4
FALSE_RATE = 0.01
LEAST_LOG2 = 12                                     # of the positions
HASHES = (668_265_263, 374_761_393, 982_451_653)    # odd, below 2**30: gram * hash fits a long
MIN_SHARE = 2e-6                                    # so at most 500,000 n-grams of a language
PIECE = 2 << 20                                     # bytes of text looked up at once
UNDETERMINED = "und"
LETTER = r"\p{L}"


def _pieces(texts: list[str]):
    """(text indices, byte lengths, joined bytes) of about PIECE bytes; long texts are cut, n-grams are not."""
    who, lengths, parts, total = [], [], [], 0
    for i, t in enumerate(texts):
        raw = b" " + t.lower().encode() + b" "
        if len(raw) == GRAM - 1:                     # one ASCII character: padded to one n-gram
            raw += b" "
        for at in range(0, max(1, len(raw) - GRAM + 1), PIECE):
            part = raw[at:at + PIECE + GRAM - 1]
            who.append(i)
            lengths.append(len(part))
            parts.append(part)
            total += len(part)
            if total >= PIECE:
                yield np.array(who), np.array(lengths), b"".join(parts)
                who, lengths, parts, total = [], [], [], 0
    if parts:
        yield np.array(who), np.array(lengths), b"".join(parts)


def _grams(lengths: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams that lie within one piece, as 32-bit numbers, and the piece of each."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    codes = b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24
    piece = np.repeat(np.arange(len(lengths)), lengths)
    inside = piece[:-3] == piece[3:]
    return codes[inside], piece[:-3][inside]


def log2_positions(n_grams: int, rate: float = FALSE_RATE) -> int:
    """The smallest filter in which ``n_grams`` are found wrongly at most at ``rate``."""
    k = len(HASHES)
    return max(LEAST_LOG2, int(np.ceil(np.log2(max(1, n_grams) * k / -np.log1p(-rate ** (1 / k))))))


def train(rows: DataFrame, min_share: float = MIN_SHARE) -> dict:
    """The filter over ``rows`` (lang, text): languages, masks by position, their number, false-positive rates.

    Rows without a language or text teach nothing.  The number of languages is
    the number of distinct values of lang, one bit each.
    """
    def count(batches):
        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            texts = b.column(1).to_pylist()
            for lang in sorted(set(langs.tolist())):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                for _, lengths, raw in _pieces(own):
                    if len(raw) >= GRAM:
                        gram, n = np.unique(_grams(lengths, raw)[0], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(gram)), pa.array(gram.astype(np.int64)),
                             pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    source = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").alias("text")).dropna()
    counts = (source.mapInArrow(count, "lang string, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    counts = save(counts, "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    words, log2 = max(1, -(-len(langs) // 63)), LEAST_LOG2
    masks = np.zeros((1 << log2, words), np.int64)
    if langs:
        at = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
        least = F.create_map(*[F.lit(x) for lang in langs for x in (lang, float(max(1.0, min_share * totals[lang])))])
        chosen = counts.filter(F.col("n") >= least[F.col("lang")]).withColumn("i", at[F.col("lang")])
        most = chosen.groupBy("lang").count().agg(F.max("count")).first()[0]
        log2 = log2_positions(most or 0)
        masks = np.zeros((1 << log2, words), np.int64)
        positions = [F.shiftright((F.col("gram") * F.lit(h)).bitwiseAND(F.lit(0xFFFFFFFF)), 32 - log2)
                     for h in HASHES]
        table = (chosen.select(F.explode(F.array(*positions)).alias("p"), F.floor(F.col("i") / 63).cast("int").alias("w"),
                               F.expr("shiftleft(1L, CAST(i % 63 AS INT))").alias("bit"))
                 .groupBy("p", "w").agg(F.bit_or("bit").alias("mask"))).toArrow()   # bounded: positions x words
        masks[table["p"].to_numpy(), table["w"].to_numpy()] = table["mask"].to_numpy()
    fill = np.array([((masks[:, i // 63] >> (i % 63)) & 1).mean() for i in range(len(langs))])
    small = next(t for t in (np.uint8, np.uint16, np.uint32, np.int64) if len(langs) <= np.iinfo(t).bits or t is np.int64)
    return {"langs": langs, "masks": [masks[:, w].astype(small) for w in range(words)], "log2": log2,
            "false_rate": fill ** len(HASHES)}


def identify(texts: list[str], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language of each text and the share of its n-grams found there.

    Ties go to the first language by name; a text whose n-grams are known
    nowhere gets the first language and score 0.
    """
    n_langs = len(model["langs"])
    hits, total = np.zeros((len(texts), n_langs)), np.zeros(len(texts))
    for who, lengths, raw in _pieces(texts):
        if len(raw) < GRAM:
            continue
        grams, piece = _grams(lengths, raw)
        total += np.bincount(who, np.bincount(piece, minlength=len(who)), len(texts))
        at = [(grams * np.uint32(h)) >> np.uint32(32 - model["log2"]) for h in HASHES]
        for w, masks in enumerate(model["masks"]):
            mask = masks[at[0]]
            for p in at[1:]:
                mask &= masks[p]
            for i in range(63 * w, min(n_langs, 63 * (w + 1))):
                found = np.bincount(piece[(mask >> (i - 63 * w)) & 1 == 1], minlength=len(who))
                hits[:, i] += np.bincount(who, found, len(texts))
    rate = model["false_rate"]
    share = (hits - total[:, None] * rate) / np.maximum(total, 1)[:, None] / np.maximum(1 - rate, 1e-9)
    share = np.clip(share, 0.0, 1.0)
    return share.argmax(axis=1), share.max(axis=1)


def predict(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row_key, lang_pred, score) of every row of ``docs``.

    ``und`` with score 0 if the text is null or has no letter, or if nothing
    was learned.  The model goes to the tasks as a broadcast variable.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        langs = np.array(m["langs"], object)
        for b in batches:
            texts, letters = b.column(2).to_pylist(), np.array(b.column(3).to_pylist(), bool)
            pred = np.full(len(texts), UNDETERMINED, object)
            score = np.zeros(len(texts))
            if len(langs) and letters.any():
                own = np.flatnonzero(letters)
                best, share = identify([texts[i] for i in own], m)
                pred[own], score[own] = langs[best], share
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pred.tolist(), pa.string()),
                                              pa.array(score)], names=["doc_id", "row_key", "lang_pred", "score"])

    source = with_row_key(docs, columns={"d": F.col(doc_id).cast("bigint"), "t": text_or_empty(text),
                                         "l": text_or_empty(text).rlike(LETTER)})
    return source.select("d", "_row_key", "t", "l").mapInArrow(
        run, "doc_id bigint, row_key bigint, lang_pred string, score double")


def learn(docs: DataFrame) -> dict:
    """Train on the rows with a language whose crc32(doc_id as text) mod 4 is not 2."""
    return train(docs.filter(crc_mod("doc_id", 4) != 2).select("lang", "text"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text has no language: null or without letters.

    These are the rows that ``predict`` gives ``und``.  A text whose n-grams
    are known nowhere has score 0 and stays.  If no row has a language to
    learn from, nothing is predicted and the same rows go.
    """
    docs = as_table(docs)
    model = learn(docs)
    if not model["langs"]:
        return docs.filter(text_or_empty("text").rlike(LETTER))
    return without(docs, predict(docs, model).filter(F.col("lang_pred") == UNDETERMINED))


def op10_language_id(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    p = predict(docs, learn(docs))
    return p.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
