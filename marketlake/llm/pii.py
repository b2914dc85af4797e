"""Personal data: candidate spans scored by gradient-boosted trees. DataFrame functions only.

Four strict forms (``BASE``) give spans that always stay.  Beside them looser
generators (``GENERATORS``) propose candidates that may overlap each other and
the strict ones: mail addresses without a dotted domain or with ``(at)``, dotted
numbers of any size, digit groups with other separators, numbers without ``+``.

Nobody has labelled spans here, so the trees learn from the strict forms: a
candidate is a positive example if a strict span of its kind lies on it.  What
makes a form strict (a checksum, the ``+``, the upper bound of a part) is no
feature; format (digits, groups, separators), context (characters and cue words
around it) and the other kinds found in the text are.  The score of a candidate
is thus the share of strict spans among candidates that look and stand like it.
On texts that took no part in the fit, each kind gets the lowest threshold at
which at least ``PRECISION`` of the candidates above it are strict; candidates
above it that no strict span touches are added.  The threshold lies in the
middle of the gap below the last score it admits, and never under a half.  A
kind with fewer than ``ENOUGH`` such candidates gets no threshold and nothing
is added.

One pass reads the texts.  The fit works on distinct feature vectors with their
counts, aggregated map-side; each level of a tree is one aggregate by (leaf,
feature, value), of which at most leaves x features x values rows come to the
driver.  Sums are of integers, so every rerun gives the same trees.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import crc_mod, read, save, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: The strict forms.  Possessive, and begun only where a run begins or the last match ended: linear in the text.
BASE = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    r"[0-9](?:[ -]?[0-9])++",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
GENERATORS = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@| ?[(\[]at[)\]] ?)[A-Za-z0-9-]++"
    r"(?:(?:\.| ?[(\[]dot[)\]] ?)[A-Za-z0-9-]++)*+",
    r"(?<![0-9A-Fa-f:.])(?:[0-9]++(?:\.[0-9]++){3}|[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7})",
    r"[0-9](?:[ ./-]{0,2}[0-9])++",
    r"[+(]?[0-9][ ().0-9/-]*[0-9]",
)
#: No span of either form in a text without a match of this.
NEEDS = (r"@|[(\[]at[)\]]", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]++:[0-9A-Fa-f]",
         r"[0-9](?:[ ./-]{0,2}[0-9]){11}", r"[0-9][ ().0-9/-]{5,}[0-9]")
#: Numbers of digits a candidate may have.
DIGITS = ((0, 1000), (0, 1000), (12, 19), (7, 15))
CUES = (r"(?i)mail|contact|write", r"(?i)\bip\b|host|server|addr", r"(?i)card|visa|master|amex|credit|pay",
        r"(?i)phone|tel\b|tel[.:]|call|mobile|cell|fax")
CONTEXT = 32                                      # characters before a candidate that are searched for cues
PARTS_TO_255 = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
FEATURES = ("kind", "digits", "groups", "length", "space", "hyphen", "dot", "bracket", "before", "after", "cue",
            "first digit", "domain labels", "other kinds")
TREES, DEPTH, RATE, RIDGE = 8, 3, 0.5, 1.0
PRECISION, ENOUGH, STEPS = 0.95, 30, 200
UNIT = 1_000_000                                  # gradients are summed in millionths
BLOCK = 64

Values = Callable[[int], Column]                  # feature number -> its column


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, the value computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sum(numbers: Column) -> Column:
    """Prefix sums of an array that is not empty, in blocks: linear in its length but for one term per block."""
    def whole(block: Column) -> Column:
        return F.aggregate(F.slice(numbers, block * BLOCK + 1, F.lit(BLOCK)), F.lit(0), lambda s, x: s + x)

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int")), whole)
    before = F.aggregate(blocks, F.array(F.lit(0)), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x)))

    def place(offsets: Column) -> Column:
        def at(_: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            own = F.slice(numbers, block * BLOCK + 1, i % BLOCK + 1)
            return F.get(offsets, block) + F.aggregate(own, F.lit(0), lambda s, x: s + x)
        return F.transform(numbers, at)

    return let(before, place)


def matches(text: Column, pattern: str, need: str) -> Column:
    """Array of (start, end, match, digits, before, after) of all leftmost matches, in code points.

    Texts without a match of ``need`` are passed over.
    """
    both = F.transform(F.filter(F.array(text), lambda t: t.rlike(need)), lambda t: F.struct(
        F.split(t, pattern, -1).alias("parts"), F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("found")))

    def located(s: Column) -> Column:
        lengths = F.transform(s["found"], lambda m, i: F.length(F.get(s["parts"], i)) + F.length(m))

        def spans(ends: Column) -> Column:
            return F.transform(s["found"], lambda m, i: F.struct(
                (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("match"),
                F.regexp_replace(m, "[^0-9]", "").alias("digits"),
                F.right(F.get(s["parts"], i), F.lit(CONTEXT)).alias("before"),
                F.left(F.get(s["parts"], i + 1), F.lit(1)).alias("after")))

        return let(lengths, lambda n: let(running_sum(n), spans))

    return F.flatten(F.transform(F.filter(both, lambda s: F.size(s["found"]) > 0), located))


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substr(F.reverse(digits), i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def strict(kind: int, m: Column) -> Column:
    n = F.length(m["digits"])
    return [lambda: F.lit(True), lambda: m["match"].rlike(PARTS_TO_255),
            lambda: F.when(n.between(14, 19), luhn(m["digits"])).otherwise(False), lambda: n.between(10, 15)][kind]()


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end), kind as its number, by start, then kind."""
    def of(kind: int) -> Column:
        found = matches(text, BASE[kind], NEEDS[kind])
        return F.transform(F.filter(found, lambda m: strict(kind, m)), lambda m: F.struct(
            m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))
    return F.array_sort(F.concat(*[of(k) for k in range(len(KINDS))]))


def overlaps(span: Column, others: Column, kind: Column | None = None) -> Column:
    return F.exists(others, lambda b: (b["start"] < span["end"]) & (b["end"] > span["start"])
                    & (F.lit(True) if kind is None else b["kind"] == kind))


def _character(c: Column) -> Column:
    return (F.when((c == "") | c.isNull() | c.rlike(r"^\s"), 0).when(c.rlike("^[0-9]"), 3)
            .when(c.rlike(r"^\p{Punct}"), 1).otherwise(2))


def candidates(text: Column, base: Column) -> Column:
    """Array of (start, kind, end, f): what the generators propose, with its features."""
    def has(m: Column, c: str) -> Column:
        return F.contains(m["match"], F.lit(c)).cast("int")

    def of(kind: int) -> Column:
        found = matches(text, GENERATORS[kind], NEEDS[kind])
        others = F.size(F.array_distinct(F.transform(F.filter(base, lambda b: b["kind"] != kind), lambda b: b["kind"])))

        def described(m: Column, others: Column) -> Column:
            domain = F.regexp_extract(m["match"], r"(?:@|[(\[]at[)\]] ?)(.*)$", 1)
            f = [F.lit(kind), F.least(F.length(m["digits"]), F.lit(20)),
                 F.least(F.size(F.regexp_extract_all(m["match"], F.lit("[0-9]++"), F.lit(0))), F.lit(8)),
                 F.least(F.floor(F.length(m["match"]) / 4).cast("int"), F.lit(10)), has(m, " "), has(m, "-"), has(m, "."),
                 F.greatest(has(m, "("), has(m, "[")), _character(F.right(m["before"], F.lit(1))), _character(m["after"]),
                 m["before"].rlike(CUES[kind]).cast("int"),
                 F.coalesce(F.left(m["digits"], F.lit(1)).try_cast("int"), F.lit(10)),
                 F.least(F.size(F.split(domain, r"\.|dot")), F.lit(4)) if kind == 0 else F.lit(0), others]
            return F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"),
                            F.array(*[x.cast("int") for x in f]).alias("f"))

        low, high = DIGITS[kind]
        fitting = F.filter(found, lambda m: F.length(m["digits"]).between(low, high))
        return let(others, lambda o: F.transform(fitting, lambda m: described(m, o)))       # counted once a text
    return F.concat(*[of(k) for k in range(len(KINDS))])


# --- boosted trees over small integer features: a tree is a value, or (feature, greatest value to the left, left, right)

def tree_value(tree, x: Values) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, most, left, right = tree
    return F.when(x(feature) <= most, tree_value(left, x)).otherwise(tree_value(right, x))


def margin(model: dict, x: Values) -> Column:
    out = F.lit(model["start"])
    for tree in model["trees"]:
        out = out + tree_value(tree, x)
    return out


def score(model: dict, x: Values) -> Column:
    return 1 / (1 + F.exp(-margin(model, x)))


def _grow(vectors: DataFrame) -> object:
    """One tree for the gradients g and h of ``vectors`` (f, g, h), level by level."""
    tree: object = 0.0

    def leaves(t, path=()):
        """(path, statistics) of the leaves still to be split; a path is a tuple of (feature, most, side)."""
        return [path] if isinstance(t, float) else leaves(t[2], (*path, (t[0], t[1], 0))) + leaves(t[3], (*path, (t[0], t[1], 1)))

    def replaced(t, path, by):
        if not path:
            return by
        f, most, side = path[0]
        return (f, most, replaced(t[2], path[1:], by), t[3]) if side == 0 else (f, most, t[2], replaced(t[3], path[1:], by))

    done: set = set()
    for _ in range(DEPTH):
        open_ = [p for p in leaves(tree) if p not in done]
        if not open_:
            break
        leaf = F.lit(-1)
        for i, path in enumerate(open_):
            on = F.lit(True)
            for f, most, side in path:
                on = on & ((F.col("f")[f] <= most) if side == 0 else (F.col("f")[f] > most))
            leaf = F.when(on, i).otherwise(leaf)
        rows = (vectors.select(leaf.alias("leaf"), F.posexplode("f").alias("feature", "value"), "g", "h")
                .filter("leaf >= 0").groupBy("leaf", "feature", "value").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect())
        table: dict = {}
        for r in rows:
            table.setdefault((r["leaf"], r["feature"]), []).append((r["value"], r["g"] / UNIT, r["h"] / UNIT))
        for i, path in enumerate(open_):
            best, whole = None, table.get((i, 0))
            if whole is None:
                done.add(path)
                continue
            g, h = sum(x[1] for x in whole), sum(x[2] for x in whole)
            for feature in range(len(FEATURES)):
                gl = hl = 0.0
                for value, dg, dh in sorted(table[i, feature])[:-1]:
                    gl, hl = gl + dg, hl + dh
                    gain = gl * gl / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g * g / (h + RIDGE)
                    if gain > 1e-3 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, feature, value, RATE * gl / (hl + RIDGE), RATE * (g - gl) / (h - hl + RIDGE))
            if best is None:
                done.add(path)
                tree = replaced(tree, path, RATE * g / (h + RIDGE))
            else:
                tree = replaced(tree, path, best[1:])
    return tree


def fit(vectors: DataFrame) -> dict:
    """Boosted trees and a threshold per kind (None: nothing is added).

    ``vectors``: f, held_out, n (rows with these features), strict (those that
    are positive), a written table.  Rows held out set the thresholds only.
    """
    seen = vectors.filter(~F.col("held_out"))
    n, p = seen.agg(F.sum("n"), F.sum("strict")).first()
    if not n or not p or p == n:
        return {"start": 0.0, "trees": [], "thresholds": [None] * len(KINDS)}
    model: dict = {"start": log(p / (n - p)), "trees": []}
    x: Values = lambda i: F.col("f")[i]
    for _ in range(TREES):
        q = score(model, x)
        tree = _grow(seen.select("f", F.round((F.col("strict") - F.col("n") * q) * UNIT).cast("bigint").alias("g"),
                                 F.round(F.col("n") * q * (1 - q) * UNIT).cast("bigint").alias("h")))
        if isinstance(tree, float):
            break
        model["trees"].append(tree)
    steps = (vectors.filter("held_out").groupBy(F.col("f")[0].alias("kind"), F.floor(score(model, x) * STEPS).alias("step"))
             .agg(F.sum("n").alias("n"), F.sum("strict").alias("strict")).collect())
    model["thresholds"] = [_threshold(sorted(((r["step"], r["n"], r["strict"]) for r in steps if r["kind"] == kind), reverse=True))
                           for kind in range(len(KINDS))]
    return model


def _threshold(steps: list[tuple[int, int, int]]) -> float | None:
    """The score from which candidates are chosen, given (step, candidates, strict ones) from the highest score down."""
    total = good = 0
    threshold = None
    for (step, n, strict_), (below, _, _) in zip(steps, [*steps[1:], (0, 0, 0)]):
        if 2 * step < STEPS:
            break
        total, good = total + n, good + strict_
        if total >= ENOUGH and good >= PRECISION * total:
            threshold = max(0.5, (step + below) / 2 / STEPS)
    return threshold


def find_candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The written table (doc_id, base, candidates) of all rows of ``docs``; the texts are read once, here."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("t"))
    rows = rows.withColumn("base", base_spans(F.col("t")))
    return save(rows.select("doc_id", "base", let(F.struct("t", "base"), lambda s: candidates(s["t"], s["base"]))
                            .alias("candidates")), "pii-candidates")


def learn(found: DataFrame) -> dict:
    """The model of all candidates in ``found``; texts whose crc32(doc_id) is a multiple of 5 are held out."""
    one = found.select((crc_mod("doc_id", 5) == 0).alias("held_out"), "base", F.explode("candidates").alias("c"))
    vectors = (one.select("held_out", "c.f", overlaps(F.col("c"), F.col("base"), F.col("c.kind")).cast("int").alias("s"))
               .groupBy("f", "held_out").agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("strict")))
    return fit(save(vectors, "pii-vectors"))


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base and spans, arrays of (start, kind, end, score) by start, then kind.

    ``kind`` is the number in KINDS; positions are code points, the end
    exclusive; ``spans`` holds ``base`` (score 1) and what the trees add.  A
    null or empty text has none; repeated rows each give a row, null ids too;
    an empty table gives none; other columns are not read.
    """
    found = find_candidates(docs, doc_id, text)
    model = learn(found)

    def scored(c: Column) -> Column:
        return F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"),
                        score(model, lambda i: F.get(c["f"], F.lit(i))).alias("score"))

    def chosen(c: Column) -> Column:
        on = F.lit(False)
        for kind, threshold in enumerate(model["thresholds"]):
            if threshold is not None:
                on = on | ((c["kind"] == kind) & (c["score"] >= threshold))
        return on

    sure = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end"),
                                                  F.lit(1.0).alias("score")))
    fresh = F.filter("candidates", lambda c: ~overlaps(c, F.col("base")))
    added = F.filter(F.transform(fresh, scored), chosen)
    return found.select("doc_id", sure.alias("base"), F.array_sort(F.concat(sure, added)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op12_personal_data(spark, sf_dir) -> DataFrame:
    found = personal_data(read(spark, sf_dir, "documents"))

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    return found.select("doc_id", *[number(k) for k in range(len(KINDS))],
                        F.sha2(F.encode(span_text(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))
