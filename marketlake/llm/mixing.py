"""Mixing sources to target weights, with DataFrame operations only.

Every source gets a target number of words: its weight's share of all words,
but at most ``most_epochs`` times its own, the excess going to the others by
weight.  A target is met by complete epochs of the source first; the fraction
that is left selects documents by Efraimidis-Spirakis keys: -ln(u) / weight,
u a hash of the doc_id, weight the document's quality weight.  Documents are
taken in key order while the prefix sum of their sizes stays within the
budget; the document at the edge is taken if more than half of it fits.

A source may hold any share of all rows, so no window spans a source.  Keys
fall into ``buckets`` ranges of their logarithm: a weight only shifts that of
a key, so no range holds more than 0.03% of the keys of any weight expected.
The sizes of (source, range) are summed first
(map-side), their prefix sums run over at most ``buckets`` rows a source, and
only the documents of the one range that holds a source's edge are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import WORD, fresh, read, save

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
BUCKETS = 32_768
LEAST_LN, MOST_LN = -8.0, 16.0                     # what lies outside is in the first or the last range
SALTS = 64
PROSE_WORD = 6.0                                   # mean characters of a word, white space included


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def quality_weight(text: str, size: str) -> Column:
    """1 for prose, less the further the mean length of a word is from that of prose."""
    mean = F.length(text) / F.greatest(F.col(size), F.lit(1))
    return F.lit(1.0) / (F.lit(1.0) + F.abs(F.coalesce(mean, F.lit(0.0)) - F.lit(PROSE_WORD)) / F.lit(PROSE_WORD))


def targets(sizes: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Sources weigh 1, 2, 3, repeating, by code point, null last.  The level L at
    which min(most_epochs * size, L * weight) sums to all words is found by
    sorting the sources by the level that fills them: with the first k filled,
    the rest would stand at one level; L is the highest of these.
    """
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     ((F.col("n") - 1) % len(weights) + 1).cast("int"))
    ranked = (sizes.withColumn("n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
              .withColumn("w", w.cast("bigint"))
              .withColumn("cap", F.col("source_size") * F.lit(int(most_epochs)))
              .withColumn("full", F.col("cap") / F.col("w")))
    order = Window.orderBy("full", "n")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
             / F.sum("w").over(after).cast("double"))
    found = (ranked.withColumn("total", F.sum("source_size").over(Window.partitionBy()))
             .withColumn("try", level)
             .withColumn("level", F.max("try").over(Window.partitionBy())))
    return found.select("source", "source_size", F.when(F.col("full") <= F.col("level"), F.col("cap").cast("double"))
                        .otherwise(F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")))
                        .alias("target"))


def keyed(docs: DataFrame, names: dict[str, str], weight: Column | None = None,
          buckets: int = BUCKETS, seed: str = "mix") -> DataFrame:
    """``docs`` with size, sampling key and key range under the given column names."""
    size, key, rng = names["size"], names["key"], names["range"]
    w = weight if weight is not None else quality_weight("text", size)
    ident = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                        F.md5(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))
    u = ((F.conv(F.substring(F.md5(F.encode(ident, "UTF-8")), 1, 12), 16, 10).cast("bigint") + F.lit(0.5))
         / F.lit(float(1 << 48)))
    return (docs.withColumn(size, size_of("text")).withColumn(key, -F.ln(u) / w)
            .withColumn(rng, F.least(F.greatest(F.floor((F.ln(F.col(key)) - F.lit(LEAST_LN)) * F.lit(buckets / (MOST_LN - LEAST_LN))),
                                                F.lit(0)), F.lit(buckets - 1)).cast("int")))


def mix_plan(rows: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: source_size, target, epochs and where its fraction ends.

    ``rows`` has doc_id, source, size, key, range.  The fraction holds every
    range before ``edge``, and of range ``edge`` the rows up to ``last``.
    """
    by_range = rows.groupBy("source", "range").agg(F.sum("size").alias("n"))
    goal = targets(by_range.groupBy("source").agg(F.sum("n").alias("source_size")), weights, most_epochs)
    goal = (goal.withColumn("epochs", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)))
            .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")))
    run = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    goal = goal.withColumnRenamed("source", "of")
    same = F.col("source").eqNullSafe(F.col("of"))
    edges = (by_range.withColumn("start", F.coalesce(F.sum("n").over(run), F.lit(0))).join(goal, same)
             .filter((F.col("start") <= F.col("budget")) & (F.col("start") + F.col("n") > F.col("budget")))
             .select("of", F.col("range").alias("edge"), (F.col("budget") - F.col("start")).alias("room")))
    order = Window.partitionBy("source").orderBy(*ORDER)
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = (rows.join(edges, same & (F.col("range") == F.col("edge")))
            .withColumn("before", before)
            .filter(F.col("before") + F.col("size") / 2 <= F.col("room"))
            .groupBy(F.col("of").alias("o")).agg(F.max(F.struct(*ORDER)).alias("last")))
    edges = edges.select(F.col("of").alias("e"), "edge")
    return save(goal.drop("budget").join(edges, F.col("of").eqNullSafe(F.col("e")), "left").drop("e")
                .join(last, F.col("of").eqNullSafe(F.col("o")), "left").drop("o"), "mix-plan")


ORDER = ("key", "doc_id", "size")                  # rows equal in all three are copies of one row


def mixed(rows: DataFrame, plan: DataFrame, names: dict[str, str]) -> DataFrame:
    """``rows`` (see ``keyed``) with the plan's columns and ``copies``, how often the mix takes the row.

    The plan is a small written table, which Spark broadcasts if its size
    allows.  Otherwise each source is joined in SALTS parts, so a hot source is
    not one task's work.
    """
    plan = plan.select(*[F.col(c).alias(names[c]) for c in PLAN],
                       F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(names["salt"]))
    here = F.struct(F.col(names["key"]).alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"),
                    F.col(names["size"]).alias("size"))
    edge, rng = F.col(names["edge"]), F.col(names["range"])
    more = (F.col(names["size"]) > 0) & ((rng < edge) | ((rng == edge) & (here <= F.col(names["last"]))))
    return (rows.join(plan, F.col("source").eqNullSafe(F.col(names["of"])) & (rng % SALTS == F.col(names["salt"])))
            .withColumn(names["copies"], (F.col(names["epochs"]) + F.coalesce(more, F.lit(False)).cast("int")).cast("int")))


PLAN = ("of", "source_size", "target", "epochs", "edge", "last")
PLAIN = {n: n for n in (*PLAN, "size", "key", "range", "copies", "salt")}


def light(docs: DataFrame, **options) -> DataFrame:
    """The written working table: doc_id, source, size, key, range of every row."""
    rows = keyed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text"), PLAIN, **options)
    return save(rows.drop("text"), "mix")


def mix(docs: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the mix takes it, same columns.

    Null text has size 0.  The null source is a source of its own, the last.
    Documents of size 0 take no words; they come with the complete epochs.  u
    is a hash of doc_id and text, so reruns agree, and rows equal in both are
    interchangeable: the edge takes all of them or none.  If no document has
    a word, all targets are 0 and nothing is taken.  Extra columns pass
    through, whatever their names.  An empty table gives no rows.
    """
    plan = mix_plan(light(docs, **options), weights, most_epochs)
    names = {n: fresh(docs, f"_{n}") for n in PLAIN}
    rows = mixed(keyed(docs, names, **options), plan, names)
    rows = rows.filter(F.col(names["copies"]) > 0)
    copy = fresh(docs, "_copy")
    return (rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(names["copies"]))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op8_mixing(spark, sf_dir) -> DataFrame:
    rows = light(read(spark, sf_dir, "documents"))
    return (mixed(rows, mix_plan(rows), PLAIN)
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         coalesce(length(text), 0) AS chars,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT
          + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM documents),
k AS (
  SELECT *, -ln(u) / (1.0::DOUBLE / (1.0::DOUBLE
         + abs(chars::DOUBLE / greatest(size, 1)::DOUBLE - 6.0::DOUBLE) / 6.0::DOUBLE)) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (
  SELECT *, [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS n FROM s),
f AS (SELECT *, 3 * source_size AS cap, (3 * source_size)::DOUBLE / w::DOUBLE AS fill FROM w),
l AS (
  SELECT *, ((sum(source_size) OVER ())
             - coalesce(sum(cap) OVER (ORDER BY fill, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(w) OVER (ORDER BY fill, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS try
  FROM f),
g AS (SELECT *, max(try) OVER () AS level FROM l),
t AS (
  SELECT source, source_size,
         CASE WHEN fill <= level THEN cap::DOUBLE ELSE least(cap::DOUBLE, level * w) END AS target FROM g),
e AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS epochs FROM t),
p AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN before + size / 2.0::DOUBLE <= target - epochs * source_size
                              THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
