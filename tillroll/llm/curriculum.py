"""Mixing sources to target weights with a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1]. Its integral
up to t, over its whole integral, is the share of the source's target that the
training run has consumed by t: the cumulative token demand. Within a source
the documents stand in a fixed order (by a digest of text and id), so each copy
of a document begins at a known point of that demand; inverting the demand
gives its training position, and a range sort by position is the training
order.

* *Targets.* The budget (``BUDGET`` times all sizes) is shared by the weights
  5, 2, 1, 5, 2, 1, ... over the sources in code-point order (null last). A
  target stops at ``MAX_EPOCHS`` times its source's size; the excess goes to
  the others by weight. With the sources sorted by (size over weight) this is
  one pass: the sources below the water line get their cap, the others share
  what is left.
* *Copies.* Copy e of a document covers ``[before + e * S, + size)`` of its
  source's demand (S: the source's size). It is taken if its middle lies below
  the target, so a source misses its target by half a document at most, and no
  document is taken more than ``MAX_EPOCHS`` times.
* *Schedules.* Weight at t runs linearly from ``w * s`` to ``w * (2 - s)``;
  s is ``START`` of the source's weight class: heavy sources fade out, light
  ones fade in. Each integral is a quadratic, inverted in closed form.

A source may hold any share of the rows: it is cut into buckets of about
``BUCKET_ROWS`` rows by the digest, running sums are taken within a bucket,
and over the bucket totals of a source. Only the table of sources, one row per
source, meets in one task.

Defined results: a null text has size 0; documents of size 0 are never taken
(their middle may lie below the target, but they add no words); a null source
is a source of its own, last in order; equal rows (same id and text) are
interchangeable and each counts; an empty table gives an empty result. Only
doc_id, text and source are read. Reruns agree: nothing depends on partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import fresh, spread, word_count, written

WEIGHTS = (5.0, 2.0, 1.0)
#: Share of the mean weight at t = 0, by weight class; 2 minus it at t = 1.
START = (1.5, 1.0, 0.5)
BUDGET = 1.5
MAX_EPOCHS = 2
BUCKET_ROWS = 4096
#: The table of sources is broadcast up to this many rows (under 1 MB).
BROADCAST_SOURCES = 10_000


def _cycle(values: tuple[float, ...], index: Column) -> Column:
    return F.get(F.array(*(F.lit(v) for v in values)), (index % len(values)).cast("int"))


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size, n_rows) with weight and target.

    One row per source meets in one task here, as the mix's configuration
    does; documents never do.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    # By size over weight, the order in which rising water reaches the caps.
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("place"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(0, Window.unboundedFollowing)
    filled = (
        sources.withColumn("place", F.row_number().over(ordered) - 1)
        .withColumn("weight", _cycle(WEIGHTS, F.col("place")))
        .withColumn("cap", MAX_EPOCHS * F.col("source_size"))
        .withColumn("budget", BUDGET * F.sum("source_size").over(everything))
        .withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(rest))
        .withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
        # The first source that isn't filled sets the level of all after it.
        .withColumn("line", F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("line") * F.col("weight"))
    return filled.select("source", "source_size", "n_rows", "place", "weight", target.alias("target"))


def position(demand: Column, start: Column) -> Column:
    """Time at which a source has used the share ``demand`` of its target.

    The weight runs from ``start`` to ``2 - start``; its integral is
    ``start * t + (1 - start) * t**2``, with the value 1 at t = 1.
    """
    bend = 1 - start
    root = F.sqrt(F.greatest(start * start + 4 * bend * demand, F.lit(0.0)))
    # 2c / (b + sqrt(b^2 + 4ac)) also holds where the quadratic part is 0.
    return F.least(F.lit(1.0), 2 * demand / (start + root))


def _measured(docs: DataFrame, size: str, key: str) -> DataFrame:
    """``docs`` with the size of each text and a digest that orders them."""
    whole = F.concat_ws("\x1f", docs["doc_id"].cast("string"), F.coalesce(docs["text"], F.lit("")))
    return docs.withColumns({size: word_count(docs["text"]), key: F.md5(whole)})


def schedule(measured: DataFrame, size: str, key: str, mix: str, facts: DataFrame | None = None) -> DataFrame:
    """``measured`` with a struct column ``mix``: size, source_size, target,
    taken, and the training positions of the copies taken (an array).

    ``facts`` are the columns source, ``size`` and ``key`` of the same rows from
    somewhere cheaper to read. Rows move once, by (source, bucket).
    """
    facts = measured if facts is None else facts
    totals = targets(
        facts.groupBy(F.col("source").alias("source")).agg(F.sum(size).alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    )
    place, bucket, begin = (fresh(measured, f"{mix}_{x}") for x in ("place", "bucket", "begin"))
    plan = written(
        totals.select(
            F.col("source").alias("_s"), F.col("place").alias(place), "source_size", "target",
            F.ceil(F.col("n_rows") / BUCKET_ROWS).alias("_span"), _cycle(START, F.col("place")).alias("_start"),
        ).withColumn(mix, F.struct("source_size", "target", "_span", "_start")).select("_s", place, mix),
        "mix-sources",
    )
    # Up to a checked number of sources the join needs no shuffle.
    plan = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan

    def dealt(rows: DataFrame) -> DataFrame:
        # The buckets of a source follow the digest's order.
        at = F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.col(mix)["_span"]
        return rows.join(plan, rows["source"].eqNullSafe(plan["_s"])).withColumn(bucket, F.shiftright(at, 32)).drop("_s")

    ahead = Window.partitionBy(place).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt(facts).groupBy(place, bucket).agg(F.sum(size).alias("_t"))
    sums = sums.select(place, bucket, F.coalesce(F.sum("_t").over(ahead), F.lit(0)).alias("_ahead"))
    within = Window.partitionBy(place, bucket).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt(measured).withColumn(begin, F.coalesce(F.sum(size).over(within), F.lit(0))).join(sums, [place, bucket])
    m, words = F.col(mix), F.col(size)
    starts = F.array(*(F.col("_ahead") + F.col(begin) + e * m["source_size"] for e in range(MAX_EPOCHS)))
    used = F.filter(starts, lambda x: (words > 0) & (x + words / 2 <= m["target"]))
    result = F.struct(
        words.alias("size"),
        m["source_size"].alias("source_size"),
        m["target"].alias("target"),
        (F.size(used) * words).alias("taken"),
        F.transform(used, lambda x: position(x / m["target"], m["_start"])).alias("positions"),
    )
    return placed.withColumn(mix, result).select(*measured.columns, mix)


def mixed(docs: DataFrame) -> DataFrame:
    """The training order: the columns of ``docs``, a row for each copy taken,
    range-sorted by training position."""
    names = docs.columns
    size, key, mix, at = (fresh(docs, f"_mix_{x}") for x in ("size", "key", "plan", "position"))
    # Inner names start with an underscore, too; documents keep their own names.
    inner = docs.select(*(F.col(c).alias(c if c in ("doc_id", "text", "source") else f"c{i}") for i, c in enumerate(names)))
    measured = _measured(inner, size, key)
    plan = schedule(measured, size, key, mix, written(measured.select("source", size, key), "mix-facts"))
    copies = plan.withColumn(at, F.explode(F.col(mix)["positions"]))
    ordered = copies.repartitionByRange(spread(docs.sparkSession), at, key).sortWithinPartitions(at, key)
    return ordered.select(*(F.col(c if c in ("doc_id", "text", "source") else f"c{i}").alias(c) for i, c in enumerate(names)))


def shares(docs: DataFrame) -> DataFrame:
    """One row per document, range-sorted by its first training position
    (documents that aren't taken last)."""
    measured = written(_measured(docs.select("doc_id", "text", "source"), "_size", "_key").drop("text"), "mix-facts")
    m = F.col("mix")
    rows = schedule(measured, "_size", "_key", "mix").select(
        "doc_id", *(m[c].alias(c) for c in ("size", "source_size", "target", "taken", "positions"))
    )
    first = F.get(F.col("positions"), 0).asc_nulls_last()
    return rows.repartitionByRange(spread(docs.sparkSession), first, "doc_id").sortWithinPartitions(first, "doc_id")
