"""Target-distribution importance resampling: documents whose words look like a target's are drawn more often.

Words and runs of words are hashed into buckets.  The log ratio of a bucket's share in the target and in
the corpus is its gain; a document weighs the mean gain of its features, and adds Gumbel noise that is a
function of its id, so that the highest scores are a weighted draw without replacement.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import ascii_lower, stage, unused

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # once A-Z are lower case
BUCKETS = 10_000
FINISH = 4096  # remaining keys that the driver sorts itself
NULL_ID = 2**63 - 1  # sorts a null id behind all others


def feature_buckets(words: Column, longest: int, buckets: int) -> Column:
    """The bucket of every run of 1 to `longest` consecutive words, repeats kept."""

    def runs(length: int) -> Column:
        if length == 1:
            text = words
        else:
            starts = F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length))
            text = F.coalesce(F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(length)])), F.array())
        return F.transform(text, lambda t: F.pmod(F.crc32(t), F.lit(buckets)).cast("int"))

    return F.concat(*[runs(n) for n in range(1, longest + 1)])


def featured(texts: DataFrame, body: str, longest: int, buckets: int) -> DataFrame:
    """`texts` with n_words and the array _buckets in the place of the text; a null text has no words."""
    words = F.array_remove(F.split(ascii_lower(F.coalesce(F.col(body), F.lit(""))), SEPARATORS, -1), "")
    split = texts.withColumn("_words", words)
    return split.withColumns(
        {"n_words": F.size("_words").cast("long"), "_buckets": feature_buckets(F.col("_words"), longest, buckets)}
    ).drop("_words", body)


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Number of features in each bucket; the driver gets a row for each bucket that has any."""
    each = features.select(F.explode("_buckets").alias("bucket")).groupBy("bucket").count().toPandas()
    counts = np.zeros(buckets)
    counts[each["bucket"].to_numpy(np.int64)] = each["count"].to_numpy(np.float64)
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of the smoothed shares of each bucket."""
    size = len(source)
    ratio = (target + 1) * (source.sum() + size) / ((source + 1) * (target.sum() + size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(features: DataFrame, gains: np.ndarray) -> DataFrame:
    """`features` with n_features and weight in the place of _buckets: the floored mean of the gains.

    The buckets of a batch are one flat array, looked up and summed at once.
    """
    kept = [f for f in features.schema.fields if f.name != "_buckets"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("_buckets"))
            n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(n)))
            sums = np.zeros(len(n), np.int64)
            full = np.flatnonzero(n)  # reduceat would give an empty list its neighbour's first value
            if len(full):
                sums[full] = np.add.reduceat(gains[flat], ends[full])
            weight = sums // np.maximum(n, 1)
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n), pa.array(weight)], [*[f.name for f in kept], "n_features", "weight"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return features.mapInArrow(score, f"{types}, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 * a Gumbel number) that depends on seed and id alone; a null id counts as empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


class Key(NamedTuple):
    """The order of the draw: high scores first, then small ids, then text hash and place in the staged table.

    The last makes keys unique, so that repeated rows are drawn one by one.
    """

    low: int  # the negative score
    id: int
    text: int
    row: int


def _key(key: Key) -> Column:
    return F.struct(*[F.lit(v).cast("long").alias(name) for name, v in key._asdict().items()])


COLUMNS = list(Key._fields)


def _median(columns: list[np.ndarray]) -> Key:
    """The lower median of unique keys: each column decides among the rows that tie in those before."""
    at, picked = (len(columns[0]) - 1) // 2, []
    for i, column in enumerate(columns):
        value = np.partition(column, at)[at]
        at -= int((column < value).sum())
        tied = column == value
        columns[i + 1 :] = [c[tied] for c in columns[i + 1 :]]
        picked.append(int(value))
    return Key(*picked)


def partition_medians(keys: DataFrame) -> list[tuple[Key, int]]:
    """The median key of each partition and the number of its keys: one row per partition."""

    def medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[batch.column(i).to_numpy() for i in range(len(COLUMNS))] for batch in batches if batch.num_rows]
        if parts:
            columns = [np.concatenate(p) for p in zip(*parts)]
            values = [*_median(columns), len(columns[0])]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in values], [*COLUMNS, "n"])

    rows = keys.select(*COLUMNS).mapInArrow(medians, ", ".join(f"{c} long" for c in [*COLUMNS, "n"])).collect()
    return [(Key(*r[:-1]), r.n) for r in rows]


def cutoff_key(keys: DataFrame, k: int, finish: int = FINISH) -> Key | None:
    """The key of rank `k` (from 1) in the order of `Key`, None for k = 0.  `keys` is staged, its keys unique.

    Each round takes the median of every partition's remaining keys and, as pivot, the median of these
    weighted by how many keys each stands for.  At least a quarter of the keys lie on either side, so
    at least a quarter goes per round, whatever the order of the rows.  What remains is written again
    once it has halved twice, so all rounds together read a few times the keys.  The last `finish` keys
    are sorted on the driver.
    """
    if k <= 0:
        return None
    remaining = written = keys.count()
    place, left = F.struct(*COLUMNS), k
    while remaining > finish:
        medians, seen = sorted(partition_medians(keys)), 0
        for pivot, n in medians:  # noqa: B007 - the pivot is used below
            seen += n
            if 2 * seen >= remaining:
                break
        upto = keys.where(place <= _key(pivot)).count()
        if upto >= left:
            keys, remaining = keys.where(place <= _key(pivot)), upto
        else:
            keys, remaining, left = keys.where(place > _key(pivot)), remaining - upto, left - upto
        if 4 * remaining <= written:
            keys, written = stage(keys, "draw-keys"), remaining
    return sorted(Key(*r) for r in keys.select(*COLUMNS).collect())[left - 1]


def ranked(winners: DataFrame, order: list[str], name: str) -> DataFrame:
    """`winners` sorted over all partitions and numbered from 1; the sort is staged.

    Part files are numbered in the order of the sort, so a row's number is its place in its file plus
    the rows of the files before: the window runs over one row per file.
    """
    sorted_rows = stage(winners.orderBy(*order), "draw-sorted")
    placed = sorted_rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    part = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("int")
    before = Window.orderBy(part, "_file").rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return placed.join(offsets, "_file").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_file", "_at", "_before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    min_words: int = 20,
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    finish: int = FINISH,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null for rows not drawn) of every row of `docs`, all long.

    Of the N rows with at least `min_words` words the floor(percent * N / 100) with the highest scores are
    drawn; ties go to the smaller id, then to the smaller text hash; a null id comes last.  `doc_id` holds whole
    numbers.  Repeated rows are drawn one by one; which of two equal rows gets the smaller rank is not
    defined.  A null or empty text has no features and weight 0.  Empty `docs` give an empty result; an
    empty `target` gives the gains of an even distribution.  Only the named columns are read.

    Texts are read once: their buckets are staged, counted, and weighed batch by batch.  The driver holds
    two counts per bucket, one key per partition and round, and the last `finish` keys.
    """
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("_body"))
    hashed = texts.withColumn("_text", F.xxhash64("_body"))
    features = stage(featured(hashed, "_body", longest, buckets), "draw-features")
    wanted = featured(target.select(F.col(f"`{target_text}`").alias("_body")), "_body", longest, buckets)
    gains = bucket_gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    score = F.col("weight") + noise(F.col("doc_id"), seed)
    scored = weighed(features, gains).withColumns({"score": score, "_row": F.monotonically_increasing_id()})
    scored = stage(scored, "draw-scores")

    keyed = scored.withColumns(
        {"low": -F.col("score"), "id": F.coalesce("doc_id", F.lit(NULL_ID)), "text": F.col("_text"), "row": F.col("_row")}
    )
    eligible = F.col("n_words") >= min_words
    drawn = percent * scored.where(eligible).count() // 100
    cutoff = cutoff_key(keyed.where(eligible).select(*COLUMNS), drawn, finish)
    result = ["doc_id", "n_features", "weight", "score"]
    if cutoff is None:
        return scored.select(*result, F.lit(None).cast("long").alias("rank"))
    won = eligible & (F.struct(*COLUMNS) <= _key(cutoff))
    winners = ranked(keyed.where(won).select(*result, *COLUMNS), COLUMNS, "rank")
    others = keyed.where(~won).select(*result, F.lit(None).cast("long").alias("rank"))
    return winners.select(*result, "rank").unionByName(others)


def draw(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` whose id is drawn, with the columns they came with; for unique ids `resample`'s draw."""
    name = unused("_drawn", docs)
    ids = resample(docs, target, doc_id=doc_id, **options).where("rank is not null").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(ids, F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col(name)), "left_semi")
