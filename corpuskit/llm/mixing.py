"""Mixing sources to target weights (problem 5).

Method: capped water-filling. Each source gets its share of the total; a source that would have to be repeated
more than ``max_repeats`` times is clamped there, and what it lacks goes to the other sources in proportion to
their weights, until all fit. In the order of share over capacity the clamped sources are a prefix, so the level
comes from window sums and takes no iteration. Records are then sampled: every record of a source is repeated the
whole part of its epochs, and a seeded choice of records fills the fractional part.

The choice is by a seeded hash of the record: a histogram over hash slots finds the slot in which the wanted size
is reached, slots below it are taken whole, and only that slot is ordered by itself. A source with a third of all
rows is therefore spread over all tasks.

Defined results: names are compared without case and outer white space; null sources, null or empty texts and rows
with retained other than true give nothing to any source; weights that are null or not above zero count as zero;
several targets of one source add up; repeated rows of one record count once; requests without targets and empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 4096


def source_name(c: Column | str) -> Column:
    """A source's name in lower case, without outer white space."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.regexp_replace(c, r"^[\s\u0085  -   　]+|[\s\u0085  -   　]+$", ""))


def mixable_records(records: DataFrame, id_col: str = "record_id", text_col: str = "code", source_col: str = "source", retained_col: str = "retained") -> DataFrame:
    """source, id, chars: the records that may be mixed, each once. Only sizes are shuffled, no texts."""
    rows = records.filter(F.col(retained_col)).select(source_name(source_col).alias("source"), F.col(id_col).alias("id"), F.length(text_col).cast("long").alias("chars"))
    return rows.filter("source is not null and id is not null and chars > 0").distinct()


def source_sizes(records: DataFrame, **cols) -> DataFrame:
    """source, size: characters of each source's mixable records."""
    return mixable_records(records, **cols).groupBy("source").agg(F.sum("chars").alias("size"))


def plan_mix(sizes: DataFrame, requests: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per mix and source: share, need, size, status, clamped, chars and epochs (chars over size).

    status is 'short' if the need exceeds max_repeats times the size (or the size is 0), which clamps the source at once,
    'repeat' if it exceeds the size, else 'fits'. chars is what water-filling gives, rounded to a millionth; a mix whose
    sources are all clamped stays below its total.
    """
    wanted = (
        targets.select("mix_id", source_name("source").alias("source"), F.when(F.col("target_weight") > 0, F.col("target_weight")).otherwise(0.0).alias("w"))
        .filter("mix_id is not null and source is not null")
        .groupBy("mix_id", "source")
        .agg(F.sum("w").alias("w"))
    )
    asked = requests.select("mix_id", "total_chars", "max_repeats").filter("mix_id is not null").distinct()
    mix = Window.partitionBy("mix_id")
    # A mix has few sources (targets are written by hand), so a window over one is small.
    rows = (
        wanted.join(asked, "mix_id")
        .join(sizes, "source", "left")
        .withColumn("size", F.coalesce("size", F.lit(0)))
        .withColumn("share", F.when(F.sum("w").over(mix) > 0, F.col("w") / F.sum("w").over(mix)).otherwise(0.0))
        .withColumn("need", F.col("share") * F.col("total_chars"))
        .withColumn("cap", (F.col("size") * F.greatest("max_repeats", F.lit(0))).cast("double"))
        .withColumn("level", F.when(F.col("cap") > 0, F.col("need") / F.col("cap")).when(F.col("need") > 0, F.lit(float("inf"))).otherwise(0.0))
    )
    order = mix.orderBy(F.col("level").desc(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("total_chars") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("fair", F.when(F.sum("w").over(onward) > 0, left * F.col("w") / F.sum("w").over(onward)).otherwise(0.0))
    # Clamped while the fair part of what is left exceeds the capacity; the first that fits ends the prefix. What exceeds it
    # by its own need does so by any larger part.
    over = (F.col("fair") > F.col("cap")) | (F.col("need") > F.col("cap"))
    rows = rows.withColumn("clamped", F.min(F.when(over, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    free_w = F.sum(F.when(~F.col("clamped"), F.col("w")).otherwise(0.0)).over(mix)
    spent = F.sum(F.when(F.col("clamped"), F.col("cap")).otherwise(0.0)).over(mix)
    rows = rows.withColumn("chars", F.when(F.col("clamped"), F.col("cap")).when(free_w > 0, F.least("cap", (F.col("total_chars") - spent) * F.col("w") / free_w)).otherwise(0.0))
    # A source is short if it is clamped by its own share already, before anything is redistributed to it.
    short = F.col("clamped") & (F.col("need") > F.col("cap"))
    status = F.when(short, "short").when(F.col("need") > F.col("size"), "repeat").otherwise("fits")
    rows = rows.withColumn("chars", F.round("chars", 6))
    return rows.select(
        "mix_id", "source", "share", "need", "size", "total_chars", "max_repeats", status.alias("status"), "clamped", "chars",
        F.when(F.col("size") > 0, F.col("chars") / F.col("size")).otherwise(0.0).alias("epochs"),
    )


def _draw(seed: int) -> Column:
    """A number of 60 bits for each mix and record, the same wherever it is drawn."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), "mix_id", "id").cast("binary")), 1, 15), 16, 10).cast("long")


def sample_mix(records: DataFrame, plan: DataFrame, seed: int = 7, **cols) -> DataFrame:
    """mix_id, source, record_id, chars, repeats: how often each record enters each mix (rows with repeats > 0).

    The actual size of a source differs from the planned one by less than one record.
    """
    rows = mixable_records(records, **cols)
    wanted = plan.filter("chars > 0").select(
        "mix_id", "source", F.floor("epochs").cast("int").alias("whole"), (F.col("chars") - F.floor("epochs") * F.col("size")).alias("rest")
    )
    mixed = rows.join(wanted, "source").withColumn("u", _draw(seed)).withColumn("slot", F.pmod("u", F.lit(SLOTS)))
    per_slot = mixed.groupBy("mix_id", "source", "slot").agg(F.sum("chars").alias("c"))
    upto = Window.partitionBy("mix_id", "source").orderBy("slot")  # at most SLOTS rows a source
    slots = per_slot.withColumn("below", F.sum("c").over(upto) - F.col("c"))
    placed = mixed.join(slots.select("mix_id", "source", "slot", "below", "c"), ["mix_id", "source", "slot"])
    # A slot is taken whole, not at all, or up to the wanted size in the order of the hash.
    sure = placed.filter("below + c <= rest or below >= rest").withColumn("extra", F.when(F.expr("below + c <= rest"), 1).otherwise(0))
    within = Window.partitionBy("mix_id", "source", "slot").orderBy("u", "id")
    split = placed.filter("below + c > rest and below < rest")
    split = split.withColumn("sum", F.sum("chars").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    split = split.withColumn("extra", F.when(F.expr("below + sum <= rest"), 1).otherwise(0)).drop("sum")
    return (
        sure.unionByName(split)
        .withColumn("repeats", F.col("whole") + F.col("extra"))
        .filter("repeats > 0")
        .select("mix_id", "source", F.col("id").alias("record_id"), "chars", "repeats")
    )


def actual_shares(sample: DataFrame, plan: DataFrame) -> DataFrame:
    """Target and actual shares of each mix and source."""
    got = sample.groupBy("mix_id", "source").agg(F.sum(F.col("chars") * F.col("repeats")).alias("actual_chars"), F.max("repeats").alias("most_repeats"))
    rows = plan.join(got, ["mix_id", "source"], "left")
    actual = F.coalesce("actual_chars", F.lit(0))
    total = F.sum(actual).over(Window.partitionBy("mix_id"))
    return rows.select(
        "mix_id", "source", "status", F.col("share").alias("target_share"), F.col("chars").alias("planned_chars"), actual.alias("actual_chars"),
        F.when(total > 0, actual / total).otherwise(0.0).alias("actual_share"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), "epochs",
    )
