"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Each source asks for its weight's share of all words. A target stops at ``max_epochs`` times its source's size; what is cut off is shared again by weight
among the other sources, until no target is above its cap. A target is then met by whole repetitions of the source and one seeded partial pass: documents
in the order of a hash, the last one in part, until the words are used up. So the words taken are the target rounded to a whole word.

A NULL text has size 0. A NULL source is a source of its own, last in order. A NULL id hashes as the empty text. Repeated rows count each; which of two
equal rows is taken in part does not show in the result. An empty table gives an empty one. Reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relfold.llm.common import pieces, stored

WEIGHTS, MAX_EPOCHS, SEED = (5, 2, 1), 3, "mix"
# The partial pass narrows the hash order twice by this many bits before it sorts documents.
BITS = 12
# The plan, one row for each source, is sent to all tasks if it is this small, else joined.
SENT_BYTES = 8 << 20


def word_count(text: Column) -> Column:
    """Words of a text: pieces between blanks that are not empty."""
    return F.size(F.array_remove(pieces(text), "")).cast("long")


def hash_order(doc_id: str, seed: str = SEED) -> Column:
    """A number below 2^60 from the id, by MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def ranked(sources: DataFrame, name: str) -> DataFrame:
    """Adds ``rank``, the place from 0 in the order of ``name`` (NULL last): ranges are counted, then numbered each on its own."""
    spark = sources.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = stored(sources.repartitionByRange(ranges, F.col(name).asc_nulls_last()).withColumn("__range", F.spark_partition_id()))
    before = F.sum("n").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1))  # a row for each range
    starts = cut.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).select("__range", F.coalesce(before, F.lit(0)).alias("__start"))
    own = F.row_number().over(W.partitionBy("__range").orderBy(F.col(name).asc_nulls_last())) - 1
    return cut.join(starts, "__range").withColumn("rank", (own + F.col("__start")).cast("long")).drop("__range", "__start")


def water_fill(sources: DataFrame, size: str, weight: str, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target``: weight times one common level, at most ``max_epochs`` times the size. Only the level and three sums pass the driver each round."""
    cap = F.col(size) * max_epochs
    total, weights = sources.agg(F.sum(size), F.sum(weight)).first()
    level, clamped = (total / weights if weights else 0.0), -1
    while True:
        above = cap < F.col(weight) * F.lit(float(level))
        caps, free, n = sources.agg(F.coalesce(F.sum(F.when(above, cap)), F.lit(0)), F.sum(F.when(~above, F.col(weight))), F.count(F.when(above, 1))).first()
        if n == clamped or not free:
            break
        level, clamped = (total - caps) / free, n
    return sources.withColumn("target", F.when(cap < F.col(weight) * F.lit(float(level)), cap.cast("double")).otherwise(F.col(weight) * F.lit(float(level))))


def turning_points(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """(m_src, r2, m_rest): for each source the range of the hash order in which the words of its partial pass run out, and the words wanted inside it.

    ``rows`` has src, size and place (the number in the hash order); ``shares`` has src and rest, the words to take. Sums over ranges find the range, then
    the same once more inside it, so nothing is sorted.
    """

    def turning(part: DataFrame, left: DataFrame, shift: int, name: str) -> DataFrame:
        by = W.partitionBy("src").orderBy("r").rowsBetween(W.unboundedPreceding, W.currentRow)
        sums = part.groupBy("src", F.shiftrightunsigned("place", shift).alias("r")).agg(F.sum("size").alias("words"))
        running = sums.withColumn("upto", F.sum("words").over(by)).alias("s").join(left.alias("t"), F.col("s.src").eqNullSafe(F.col("t.src")))
        here = (F.col("upto") >= F.col("t.rest")) & (F.col("upto") - F.col("words") < F.col("t.rest"))
        return running.where(here).select(F.col("s.src").alias("src"), F.col("r").alias(name), (F.col("t.rest") - F.col("upto") + F.col("words")).alias("rest"))

    one = stored(turning(rows, shares.where("rest > 0"), 60 - BITS, "r1"))
    inside = rows.alias("d").join(one.alias("o"), F.col("d.src").eqNullSafe(F.col("o.src")) & (F.shiftrightunsigned("d.place", 60 - BITS) == F.col("o.r1"))).select("d.*")
    return turning(inside, one, 60 - 2 * BITS, "r2").select(F.col("src").alias("m_src"), "r2", F.col("rest").alias("m_rest"))


def small(df: DataFrame, name: str) -> DataFrame:
    """The table with a broadcast hint if its measured size is below SENT_BYTES."""
    size = df.agg(F.sum(F.coalesce(F.length(name), F.lit(0)) + 64)).first()[0] or 0
    return F.broadcast(df) if size <= SENT_BYTES else df


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: Sequence[str] = (), weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """(id, src, size, source_size, target, epochs, part, taken) of each row: ``epochs`` whole repetitions and ``part`` words more make ``taken``. The ``keep`` columns, if any, come
    along in one struct column ``kept``, so their names may be any.

    The weights are dealt to the sources in code point order, from the start again when they run out.
    """
    carried = [F.struct(*keep).alias("kept")] if keep else []
    full = docs.select(*carried, F.col(doc_id).alias("id"), F.col(source).cast("string").alias("src"), word_count(F.col(text)).alias("size"), hash_order(doc_id, seed).alias("place"))
    rows = stored(full.select("id", "src", "size", "place"))
    sizes = ranked(rows.groupBy("src").agg(F.sum("size").alias("source_size")), "src")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int"))
    filled = water_fill(stored(sizes.withColumn("weight", weight)), "source_size", "weight", max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    shares = stored(filled.withColumn("epochs", epochs).withColumn("rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5).cast("long")))
    points = turning_points(rows, shares.select("src", "rest"))
    plan = small(stored(shares.join(points, F.col("src").eqNullSafe(F.col("m_src")), "left").select(F.col("src").alias("p_src"), "source_size", "target", "epochs", "r2", "m_rest")), "p_src")
    marked = (full if keep else rows).join(plan, F.col("src").eqNullSafe(F.col("p_src")), "left").withColumn("r", F.shiftrightunsigned("place", 60 - 2 * BITS))
    # earlier ranges are taken whole, later ones not; only the range in between is sorted
    decided = marked.where("r2 IS NULL OR r <> r2").withColumn("part", F.when(F.col("r") < F.col("r2"), F.col("size")).otherwise(F.lit(0).cast("long")))
    before = F.sum("size").over(W.partitionBy("src").orderBy("place", "size").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size")
    last = marked.where("r = r2").withColumn("part", F.least(F.col("size"), F.greatest(F.col("m_rest") - before, F.lit(0))).cast("long"))
    out = decided.unionByName(last).withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
    return out.select(*(["kept"] if keep else []), "id", "src", "size", "source_size", "target", "epochs", "part", "taken")
