"""Mixing sources to target weights by Pfair scheduling (DataFrame functions only).

Every source is cut into blocks. With a target weight w, block i (from 1) of a source may
start at slot floor((i-1)/w) and must be placed before slot ceil(i/w). Earliest deadline
first over the released blocks meets all deadlines, so after any number of slots a source
is less than one block away from its weight. Weights are whole shares of a period of fixed
length; all deviations are zero at its end, so one period is scheduled, in one row whose
size the parameters bound, and every block finds its slot by (block mod share). Nothing
walks over the data: the cost is a rank within each source.

A source that ends early leaves its slots empty and the others keep theirs. No row is
dropped or repeated.

The rank within a source follows the MD5 of the id, so neighbours in the input do not stay
together. It is counted within (source, leading hex digits) and the counts of earlier digits
are added, so a source with a third of all rows is spread over many tasks.

Defined results
  - a null source is a source of its own (empty name in `weights`); null ids and null or
    empty texts are ranked like others; equal rows get places of their own;
  - sources without a weight get the smallest share; an empty table gives an empty result;
  - columns of the input stay, except those with the names of the added ones, which are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkgauge.llm.common import small, store

PERIOD = 200
BLOCK_ROWS = 64
ADDED = ("weight_share", "block", "release", "deadline", "slot", "place")
_OWN = ("_source", "_digest", "_text", "_lead", "_row")


def shares(sources: DataFrame, weights: Mapping[str, float] | None, period: int) -> DataFrame:
    """Whole shares of the period per source: largest remainders, at least one each.

    sources has the columns _source and n (rows). Without weights the target is the square
    root of the row counts, which raises small sources. The period grows to twice the number
    of sources if there are more than half as many sources as slots.
    """
    if weights:
        known = F.create_map(*[F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))])
        target = F.coalesce(known[F.col("_source")], F.lit(0.0))
    else:
        target = F.sqrt("n")
    whole = Window.partitionBy(F.lit(0))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("_rest").desc(), F.col("_source"))
    return (
        sources.withColumn("_t", target)
        .withColumn("_sources", F.count(F.lit(1)).over(whole))
        .withColumn("period", F.greatest(F.lit(period), F.col("_sources") * 2))
        .withColumn("_t", F.col("_t") / F.sum("_t").over(whole) * (F.col("period") - F.col("_sources")))
        .withColumn("_rest", F.round(F.col("_t") - F.floor("_t"), 9))
        .withColumn("_left", F.col("period") - F.sum(F.floor("_t") + 1).over(whole))
        .withColumn("share", F.floor("_t") + 1 + (F.row_number().over(order) <= F.col("_left")).cast("long"))
        .select("_source", "share", "period")
    )


def period_slots(table: DataFrame) -> DataFrame:
    """Slots of one period by earliest deadline first: _source, share, period, k (0..share-1), slot0.

    One row holds the shares of all sources; at each slot the state keeps how many blocks
    of each have been placed. A block is released when k*period < (t+1)*share, that is, its
    floor(k/w) is at most t; its deadline is ceil((k+1)*period/share).
    """
    packed = table.groupBy("period").agg(F.array_sort(F.collect_list(F.struct("_source", "share"))).alias("s"))
    state = F.struct(
        F.transform("s", lambda x: F.lit(0).cast("long")).alias("placed"),
        F.array().cast("array<int>").alias("picks"),
    )

    def step(acc: Column, t: Column) -> Column:
        ready = F.transform(
            F.arrays_zip(F.col("s"), acc["placed"].alias("placed")),
            lambda z, i: F.when(
                (z["placed"] < z["s"]["share"]) & (F.floor(z["placed"] * F.col("period") / z["s"]["share"]) <= t),
                F.struct(F.ceil((z["placed"] + 1) * F.col("period") / z["s"]["share"]).alias("deadline"), i.alias("i")),
            ),
        )
        pick = F.array_min(ready)["i"]
        return F.struct(
            F.transform(acc["placed"], lambda p, i: p + F.coalesce((i == pick).cast("long"), F.lit(0))).alias("placed"),
            F.concat(acc["picks"], F.array(pick)).alias("picks"),
        )

    picks = F.aggregate(F.sequence(F.lit(0), (F.col("period") - 1).cast("int")), state, step, lambda acc: acc["picks"])
    slots = packed.select("period", "s", picks.alias("picks")).select(
        "period", "s", F.posexplode("picks").alias("slot0", "i")
    )
    placed = slots.select("period", F.get("s", F.col("i")).alias("x"), "slot0").select(
        F.col("x._source").alias("_source"), F.col("x.share").alias("share"), "period", F.col("slot0").cast("long")
    )
    return placed.withColumn(
        "k", F.row_number().over(Window.partitionBy("_source").orderBy("slot0")).cast("long") - 1
    )


def mix(
    docs: DataFrame, weights: Mapping[str, float] | None = None, block_rows: int = BLOCK_ROWS, period: int = PERIOD
) -> DataFrame:
    """The documents with weight_share, block (from 0), release, deadline, slot and place (order in the block)."""
    kept = [c for c in docs.columns if c not in ADDED and c not in _OWN]
    keyed = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_digest"),
        F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("_text"),
    )
    rows = keyed.groupBy("_source").agg(F.count(F.lit(1)).alias("n"))
    sources = store(rows, "sources")
    total = sources.agg(F.sum("n")).first()[0] or 0
    # So many leading hex digits that a source's part in one of them stays small at any size.
    digits = max(2, math.ceil(math.log(max(total, 1) / 50_000 + 1, 16)))

    keyed = keyed.withColumn("_lead", F.substring("_digest", 1, digits))
    parts = keyed.groupBy("_source", "_lead").agg(F.count(F.lit(1)).alias("_n"))
    before = parts.select(
        "_source",
        "_lead",
        (F.sum("_n").over(Window.partitionBy("_source").orderBy("_lead")) - F.col("_n")).alias("_before"),
    )
    in_part = Window.partitionBy("_source", "_lead").orderBy("_digest", "_text")
    ranked = (
        keyed.withColumn("_row", F.row_number().over(in_part))
        .join(before, ["_source", "_lead"])
        .withColumn("_row", F.col("_before") + F.col("_row") - 1)
        .withColumn("block", F.floor(F.col("_row") / block_rows))
        .withColumn("place", F.col("_row") % block_rows)
    )
    plan = store(period_slots(shares(sources, weights, period)), "period")
    share_of = plan.select("_source", "share", "period").distinct()
    return (
        ranked.join(small(share_of), "_source")
        .withColumn("k", F.col("block") % F.col("share"))
        .join(small(plan.select("_source", "k", "slot0")), ["_source", "k"])
        .select(
            *[F.col(f"`{c}`") for c in kept],
            (F.col("share") / F.col("period")).alias("weight_share"),
            "block",
            F.floor(F.col("block") * F.col("period") / F.col("share")).alias("release"),
            F.ceil((F.col("block") + 1) * F.col("period") / F.col("share")).alias("deadline"),
            (F.floor(F.col("block") / F.col("share")) * F.col("period") + F.col("slot0")).alias("slot"),
            F.col("place").cast("long").alias("place"),
        )
    )
