"""Packing: optimal length buckets and token-budget batches inside each."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import numbered, stage

TOKEN = r"[^\x20\x09-\x0D]+"


def best_boundaries(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` length buckets with the least padding in total.

    `histogram` holds (length, rows).  best[j] is the least padding of the j shortest lengths in b
    buckets; the last of them holds lengths i..j-1, padded to the longest.  Exact, by dynamic
    programming over all cut points; of equal solutions the one with the earliest cuts.
    """
    if not histogram:
        return []
    lengths, rows = (np.array(x, dtype=np.int64) for x in zip(*sorted(histogram)))
    count = np.concatenate(([0], np.cumsum(rows)))
    tokens = np.concatenate(([0], np.cumsum(rows * lengths)))
    n = len(lengths)
    best = np.concatenate(([0], lengths * count[1:] - tokens[1:]))  # one bucket
    cuts = []
    for _ in range(min(buckets, n) - 1):
        cut, improved = np.zeros(n + 1, np.int64), best.copy()
        for j in range(1, n + 1):
            padding = best[:j] + lengths[j - 1] * (count[j] - count[:j]) - (tokens[j] - tokens[:j])
            cut[j] = int(np.argmin(padding))
            improved[j] = padding[cut[j]]
        cuts.append(cut)
        best = improved
    bounds, j = [int(lengths[-1])], n
    for cut in reversed(cuts):
        j = int(cut[j])
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
    return sorted(set(bounds))


def _pick(bucket: Column, values: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (bucket + 1).cast("int"))


def pack_documents(
    docs: DataFrame,
    max_tokens: int = 2048,
    buckets: int = 8,
    batch_tokens: int = 16384,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every document cut into sequences, each with its bucket, batch and row.

    A token is a run without ASCII white space.  A document of more than `max_tokens` tokens becomes
    several sequences, so no token is lost: columns doc_id, piece, token_start, n_tokens, bucket,
    bucket_tokens (the padded length), batch (numbered from 0 in each bucket), batch_row.  A batch
    holds as many rows of its bucket as fit `batch_tokens` when padded.  The histogram has at most
    `max_tokens` rows, whatever the input, and the driver finds the boundaries from it.

    Null, empty and blank texts keep one row with n_tokens 0 and no bucket, batch or row.  Repeated
    rows and null ids are rows of their own.  An empty table gives an empty result; other columns
    are not read.
    """
    if not 0 < max_tokens <= batch_tokens:
        raise ValueError("max_tokens has to be positive and no more than batch_tokens")
    n_tokens = F.coalesce(F.regexp_count(F.col(text), F.lit(TOKEN)), F.lit(0)).cast("long")
    last = F.floor(F.greatest(F.col("_tokens") - 1, F.lit(0)) / max_tokens)
    pieces = (
        docs.select(F.col(doc_id).alias("doc_id"), n_tokens.alias("_tokens"))
        .select("doc_id", "_tokens", F.explode_outer(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
        .withColumn("token_start", F.col("piece") * max_tokens)
        .withColumn("n_tokens", F.least(F.lit(max_tokens).cast("long"), F.col("_tokens") - F.col("token_start")))
        .drop("_tokens")
    )
    pieces = stage(pieces, "pack-pieces")
    full = pieces.where("n_tokens > 0")
    histogram = full.groupBy("n_tokens").count().collect()  # at most max_tokens rows
    bounds = best_boundaries([(r["n_tokens"], r["count"]) for r in histogram], buckets)
    columns = ["doc_id", "piece", "token_start", "n_tokens", "bucket", "bucket_tokens", "batch", "batch_row"]
    nothing = {c: F.lit(None).cast(t) for c, t in (("bucket", "int"), ("bucket_tokens", "long"), ("batch", "long"), ("batch_row", "long"))}
    blank = pieces.where("n_tokens = 0").withColumns(nothing).select(*columns)
    if not bounds:
        return blank
    bucket = sum(((F.col("n_tokens") > b).cast("int") for b in bounds), F.lit(0))
    capacity = _pick(F.col("bucket"), [batch_tokens // b for b in bounds])
    placed = (
        numbered(full.withColumn("bucket", bucket), ["bucket"], ["doc_id", "piece", "n_tokens"], "_slot")
        .withColumn("bucket_tokens", _pick(F.col("bucket"), bounds).cast("long"))
        .withColumn("batch", F.floor(F.col("_slot") / capacity).cast("long"))
        .withColumn("batch_row", (F.col("_slot") % capacity).cast("long"))
    )
    return placed.select(*columns).unionByName(blank)
