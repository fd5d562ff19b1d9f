"""Sharding: longest-processing-time scheduling of groups that must stay together."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import numbered, stage

CLASS_BITS = 11  # significant bits that a size keeps in its class: sizes of a class differ by under 0.1 %
LARGE = 1000  # a group is large, and scheduled by its exact size, from this part of a shard's mean load


def size_class(size: Column) -> Column:
    """The size with all but its leading bits cleared: at most 2**11 classes for each power of two."""
    drop = F.greatest(F.length(F.bin(size)) - F.lit(CLASS_BITS), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)


def longest_first(classes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Deal groups, largest class first, each to the least loaded shard (the lowest of equals).

    `classes` holds (class, groups, their total size); the result holds runs (class, first, end,
    shard): the groups ranked first to end - 1 of the class go to the shard.  A heap keeps the
    loads.  Of a class with many groups, all steps below a common water level are taken at once,
    since there the heap would only go round; the result is the same.
    """
    loads = [(0.0, shard) for shard in range(shards)]
    runs = []
    for size_of_class, groups, total in sorted(classes, reverse=True):
        mean = total / groups
        dealt = [0] * shards
        left = groups
        if groups > 4 * shards:
            level = _water_level([load for load, _ in loads], (groups - shards) * mean)
            for i, (load, shard) in enumerate(loads):
                taken = max(0, int((level - load) // mean))
                dealt[shard] = taken
                loads[i] = (load + taken * mean, shard)
                left -= taken
            heapq.heapify(loads)
        for _ in range(left):
            load, shard = loads[0]
            dealt[shard] += 1
            heapq.heapreplace(loads, (load + mean, shard))
        first = 0
        for shard, taken in enumerate(dealt):
            if taken:
                runs.append((size_of_class, first, first + taken, shard))
                first += taken
    return runs


def _water_level(loads: list[float], volume: float) -> float:
    """The level up to which `volume` fills the room above the loads."""
    lowest = sorted(loads)
    filled = 0.0
    for i, load in enumerate(lowest[1:], 1):
        step = (load - lowest[i - 1]) * i
        if filled + step >= volume:
            return lowest[i - 1] + (volume - filled) / i
        filled += step
    return lowest[-1] + (volume - filled) / len(lowest)


def shard_groups(rows: DataFrame, group: str, size: str, shards: int) -> DataFrame:
    """(group, shard) for every value of `group`, which holds no nulls.

    Groups of a thousandth of a shard's mean load or more, LARGE * `shards` at most, are scheduled by
    their exact sizes.  Smaller ones come after them, in classes of 11 significant bits by the mean
    size of the class, so that none moves a load by more than a thousandth.  The driver sees one row
    per class, some 80,000 and the large ones at the very most whatever the input.  Inside a class
    groups are ranked by salted numbers, so a class with most of all groups makes no large task.
    """
    spark = rows.sparkSession
    groups = stage(rows.groupBy(group).agg(F.sum(size).cast("long").alias("_size")), "shard-groups")
    large = (groups.agg(F.sum("_size")).first()[0] or 0) / (LARGE * shards)
    exact = F.col("_size") >= F.greatest(F.lit(large), F.lit(1.0))
    groups = groups.withColumn("_class", F.when(exact, F.col("_size")).otherwise(size_class(F.col("_size"))))
    totals = groups.groupBy("_class").agg(F.count(F.lit(1)).alias("groups"), F.sum("_size").alias("total"))
    runs = longest_first([(r["_class"], r["groups"], r["total"]) for r in totals.collect()], shards)
    dealt = spark.createDataFrame(runs, "_class long, _first long, _end long, shard int")
    ranked = numbered(groups, ["_class"], [group], "_rank")
    inside = (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end"))
    return ranked.join(dealt, "_class").where(inside).select(group, "shard")


def shard_documents(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of `docs` with its shard and its place in the shard; equal texts share a shard.

    Columns: doc_id, size (UTF-8 bytes of the text plus 1), text_crc32 (null for a null text), law
    (`bytes`: sizes near equal), shard, slot (gapless from 0 in each shard), grown_shard (null, as
    the law is not `key`).  Null texts form one group, empty texts another.  Repeated rows and null
    ids are kept as rows of their own; an empty table gives an empty result.  Other columns are not
    read.  A group is never split, so one that outweighs a shard leaves that shard heavier.
    """
    body = F.col(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.coalesce(F.sha2(body.cast("binary"), 256), F.lit("null")).alias("_text"),
    )
    rows = stage(rows, "shard-rows")
    placed = rows.join(shard_groups(rows, "_text", "size", shards), "_text").drop("_text")
    placed = stage(placed, "shard-placed")
    return numbered(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
