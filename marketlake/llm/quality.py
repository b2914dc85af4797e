"""Quality classifier: naive Bayes support vectors.

Each text is the set of its byte n-grams (1 to 3 bytes, hashed to ``FEATURES``
indicators).  The log-count ratio of the two classes scales every indicator,
and a linear model with hinge loss is fitted to the scaled, length-normalised
rows by dual coordinate descent.  Margins become probabilities by a logistic
curve fitted to rows that the model did not see.

The fit uses the ``SAMPLE`` labelled rows whose doc_ids hash lowest, each
(doc_id, label, indicators) once, and of these no more than have
``SAMPLE_BYTES`` of indicators, so its task is bounded in rows and bytes
whatever the corpus; the sample's ids (16 bytes each) are the only thing joined
to the texts, by broadcast.  Scoring is one
pass over all texts with a weight vector of fixed size, and shuffles nothing.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import crc_mod, read, save, text_or_empty

SAMPLE = 20_000
SAMPLE_BYTES = 512 << 20
LOG2_FEATURES = 18
FEATURES = 1 << LOG2_FEATURES
REPEATS = (1, 2, 3, 5, 8)
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
HELD_BACK = 5                                       # every fifth row of the sample fits the logistic curve
THRESHOLD = 0.3
PIECE = 4 << 20
MODEL_DDL = "weights binary, bias double, slope double, offset double"


def features(text: str, flags: np.ndarray) -> np.ndarray:
    """Sorted indices of the n-grams in ``text``; ``flags`` is an all-zero buffer of FEATURES bytes.

    Besides the byte n-grams there are indicators of a word or a line that
    stands several times in a row (REPEATS more times, at least).
    """
    raw = np.frombuffer(text.encode(), np.uint8)
    for at in range(0, len(raw), PIECE):            # long texts in overlapping pieces
        b = raw[at:at + PIECE + 2].astype(np.uint32)
        flags[(b * np.uint32(0x9E3779B1)) >> np.uint32(32 - LOG2_FEATURES)] = 1
        for n in (2, 3):
            if len(b) >= n:
                code = b[:len(b) - n + 1] + np.uint32(n << 24)
                for k in range(1, n):
                    code = code + (b[k:len(b) - n + 1 + k] << np.uint32(8 * k))
                flags[(code * np.uint32(0x85EBCA6B)) >> np.uint32(32 - LOG2_FEATURES)] = 1
    for number, units in enumerate((text.encode().split(), text.splitlines())):
        equal = bytes(map(eq, units, units[1:]))    # n-grams of one word, or line, over and over
        for k, n in enumerate(REPEATS):
            if b"\x01" * n in equal:
                flags[FEATURES - 1 - k - number * len(REPEATS)] = 1
    found = np.flatnonzero(flags)
    flags[found] = 0
    return found


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log of how much more common each indicator is in class 1 than in class 0."""
    counts = [np.bincount(np.concatenate([r for r, v in zip(rows, y) if v == c] or [np.empty(0, np.int64)]),
                          minlength=FEATURES) + SMOOTHING for c in (1, 0)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray,
                            epochs: int = EPOCHS, cost: float = COST) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model; the classes' costs are balanced.

    Each step solves one dual variable exactly within [0, cost] and moves the
    weights along that row.
    """
    w, bias = np.zeros(FEATURES), 0.0
    sign = np.where(y == 1, 1.0, -1.0)
    most = np.where(y == 1, cost * len(y) / max(1, 2 * (y == 1).sum()), cost * len(y) / max(1, 2 * (y == 0).sum()))
    dual, rng = np.zeros(len(y)), np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            idx, x = rows[i], values[i]
            gradient = sign[i] * (w[idx] @ x + bias) - 1.0
            new = min(max(dual[i] - gradient / (x @ x + 1.0), 0.0), most[i])
            if step := new - dual[i]:
                dual[i] = new
                w[idx] += step * sign[i] * x
                bias += step * sign[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def logistic_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of P(1) = 1 / (1 + exp(-(slope * margin + offset))), by Newton steps."""
    target = np.where(y == 1, ((y == 1).sum() + 1) / ((y == 1).sum() + 2), 1 / ((y == 0).sum() + 2))
    x = np.column_stack([margin, np.ones(len(margin))])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p))
        beta = beta + np.clip(step, -5, 5)
        if abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(rows: list[np.ndarray], y: np.ndarray) -> dict:
    """The model; with one class only, or none, every score is that class's smoothed share."""
    share = ((y == 1).sum() + 1) / (len(y) + 2)
    flat = {"weights": np.zeros(FEATURES, np.float32), "bias": 0.0, "slope": 0.0,
            "offset": float(np.log(share / (1 - share)))}
    if len(set(y.tolist())) < 2:
        return flat
    ratio = log_count_ratio(rows, y)

    def scaled(r):
        x = ratio[r]
        return x / max(np.sqrt(x @ x), 1e-12)

    values = [scaled(r) for r in rows]
    seen = np.arange(len(y)) % HELD_BACK != 0
    if len(set(y[seen].tolist())) < 2 or len(set(y[~seen].tolist())) < 2:
        seen = np.ones(len(y), bool)
    part = np.flatnonzero(seen)
    w, bias = dual_coordinate_descent([rows[i] for i in part], [values[i] for i in part], y[part])
    rest = np.flatnonzero(~seen) if not seen.all() else part
    margin = np.array([w[rows[i]] @ values[i] + bias for i in rest])
    slope, offset = logistic_curve(margin, y[rest])
    w, bias = dual_coordinate_descent(rows, values, y)
    # the row's norm divides the margin, so the ratio is kept beside the product
    return {"weights": np.stack([(w * ratio), ratio ** 2]).astype(np.float32), "bias": float(bias),
            "slope": slope, "offset": offset}


def margins(rows: list[np.ndarray], model: dict) -> np.ndarray:
    weights, squares = model["weights"]
    return np.array([weights[r].sum(dtype=np.float64) / max(np.sqrt(squares[r].sum(dtype=np.float64)), 1e-12)
                     + model["bias"] for r in rows])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> dict:
    """Fit on rows (doc_id, quality) of ``labels`` whose crc32(doc_id as text) mod 5 is not 0.

    Labels other than 0 and 1, null ids and labels without a document teach
    nothing.  At most ``sample`` rows are used, those whose ids hash lowest;
    repeated rows count once, and rows of one id with other texts or labels
    each.  In that order, rows behind ``sample_bytes`` of indicators are left out.
    """
    chosen = (labels.filter((crc_mod("doc_id", 5) > 0) & F.col("quality").isin(0, 1))
              .select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty("text").alias("t"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "t")   # at most `sample` rows

    def extract(batches):
        flags = np.zeros(FEATURES, np.uint8)
        for b in batches:
            found = [features(t, flags).astype("<u4").tobytes() for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.binary())],
                                             names=["doc_id", "quality", "features"])

    def fit_all(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "quality", "features")])
        found = [np.frombuffer(x, "<u4").astype(np.int64) for x in table["features"].to_pylist()]
        m = fit(found, table["quality"].to_numpy())
        return pa.table({"weights": [np.ascontiguousarray(m["weights"], "<f4").tobytes()], "bias": [m["bias"]],
                         "slope": [m["slope"]], "offset": [m["offset"]]})

    keys = ["doc_id", "quality", "digest"]
    found = (rows.mapInArrow(extract, "doc_id bigint, quality int, features binary")
             .withColumn("digest", F.md5("features")).groupBy(*keys).agg(F.first("features").alias("features")))
    found = save(found, "quality-sample")
    order = [F.xxhash64("doc_id"), *keys]
    least = (found.select(*keys, F.length("features").cast("bigint").alias("n"))
             .orderBy(*order).limit(sample)          # so the window has no more rows than this
             .withColumn("upto", F.sum("n").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
             .filter(F.col("upto") <= sample_bytes).select(*keys))
    model = (found.join(least, keys, "left_semi").select("doc_id", "quality", "features")
             .groupBy().applyInArrow(fit_all, MODEL_DDL).first())
    if model is None:
        return {"weights": np.zeros((2, FEATURES), np.float32), "bias": 0.0, "slope": 0.0, "offset": 0.0}
    w = np.frombuffer(bytes(model["weights"]), "<f4")
    w = w.reshape(2, FEATURES) if len(w) == 2 * FEATURES else np.zeros((2, FEATURES), np.float32)
    return {"weights": w, "bias": model["bias"], "slope": model["slope"], "offset": model["offset"]}


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row of ``docs``: the probability of quality 1.

    A null or empty text has no features and gets the score of the bias alone.
    Without anything learned the score is 0.5.  An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m, flags = shared.value, np.zeros(FEATURES, np.uint8)
        for b in batches:
            margin = margins([features(t, flags) for t in b.column(1).to_pylist()], m)
            p = 1 / (1 + np.exp(-np.clip(m["slope"] * margin + m["offset"], -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64())], names=["doc_id", "score"])

    source = docs.select(F.col(doc_id).cast("bigint").alias("d"), text_or_empty(text).alias("t"))
    return source.mapInArrow(run, "doc_id bigint, score double")


def op9_quality(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = score(docs, learn(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
