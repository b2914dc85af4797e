"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import save

PARTS = 1024                                         # parts that a node's links are split into


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _with_least(pairs: DataFrame) -> DataFrame:
    """``pairs`` with m, the smallest v of their u.

    A centre may have a third of all rows, so the rows of a node are split into
    ``PARTS`` by v: the smallest is taken of each part, then of a node's parts,
    and goes back to the parts and from them to the rows.  No step has more than
    ``PARTS`` rows, or one part's rows, of a node in one place.
    """
    parts = pairs.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(PARTS)).cast("int"))
    by_part = parts.groupBy("u", "part").agg(F.min("v").alias("m"))
    least = by_part.groupBy("u").agg(F.min("m").alias("m"))
    return parts.join(by_part.select("u", "part").join(least, "u"), ["u", "part"]).drop("part")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it sees, itself included."""
    return (_with_least(_neighbours(edges)).filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    known = _with_least(down)
    # the smallest neighbour's own row becomes the node's link to it
    return known.select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"),
                        F.col("m").alias("v"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long): root is the smallest node it reaches.

    Self-links and repeated links are allowed; no edges give no rows.  Each
    round is written, so a lost executor never replays earlier rounds; the
    driver reads one count and one checksum a round.
    """
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = save(edges.select("u", "v").filter(F.col("u") != F.col("v")).distinct(), "cc")
    before = state(now)
    for _ in range(most_rounds):
        if not before[0]:
            break
        now = save(_small_star(_large_star(now)).filter(F.col("u") != F.col("v")).distinct(), "cc")
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no fixpoint after {most_rounds} rounds")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
