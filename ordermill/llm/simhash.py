"""SimHash near-dedup: 64-bit fingerprints, linked by a join over tables of distances to pivots."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.blocks import key_runs, star_edges
from ordermill.llm.common import stage
from ordermill.llm.components import components

SEED = 42
PIVOTS = 24
CHUNK = 2048  # fingerprints of one block that a task compares at a time with as many others


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The fingerprint of one text; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    joined = [words] if len(words) < shingle else zip(*(words[k:] for k in range(shingle)))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(w), SEED) for w in joined), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, _text (hash of the text), fp (the 64 bits as a signed long)."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint_of(t.as_py(), shingle) for t in batch.column("_body")]
            fps = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_text"), fps], ["doc_id", "_text", "fp"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("_text"), F.col(text).alias("_body"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(fill, f"doc_id {kind}, _text long, fp long")


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: fixed pseudo-random words, the same in every run and task."""
    return np.array([xxhash.xxh64_intdigest(f"pivot {i}", SEED) for i in range(n)], dtype=np.uint64)


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each pivot."""
    return np.bitwise_count(fps[:, None] ^ pivots()[None, :])


def linked(fps: np.ndarray, keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of fingerprints with one key that differ in at most `most` bits.

    Rows of a key are sorted by their distance to the first pivot.  By the triangle inequality a
    partner lies within `most` of it in every coordinate: the sorted first one bounds how far to
    look, the largest coordinate difference discards, and only survivors are compared bit by bit.
    """
    table = pivot_table(fps)
    order = np.lexsort((table[:, 0], keys))
    fps, keys, table = fps[order], keys[order], table[order].astype(np.int16)
    # one past the last partner of each row: same key, first coordinate at most `most` larger
    rank = np.cumsum(np.concatenate(([0], keys[1:] != keys[:-1]))) * 256 + table[:, 0]
    until = np.searchsorted(rank, rank + most, side="right")
    left, right = [], []
    active = np.flatnonzero(until > np.arange(len(fps)) + 1)
    step = 1
    while len(active):
        other = active + step
        near = np.abs(table[active, 1:] - table[other, 1:]).max(axis=1) <= most
        a, b = active[near], other[near]
        same = np.bitwise_count(fps[a] ^ fps[b]) <= most
        left.append(order[a[same]])
        right.append(order[b[same]])
        step += 1
        active = active[until[active] > active + step]
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _block_edges(most: int):
    """Spanning links of the fingerprints that share a block key, at most one per member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, "block"):
            keys = rows.column("block").to_numpy()
            signed = rows.column("fp").to_numpy()
            a, b = linked(signed.view(np.uint64), keys, most)
            members, roots = star_edges(len(signed), np.minimum(a, b), np.maximum(a, b))
            yield pa.RecordBatch.from_arrays([pa.array(signed[members]), pa.array(signed[roots])], ["a", "b"])

    return run


def block_keys(fp: Column, most: int) -> Column:
    """Every choice of equal blocks as a hashed key.

    The 64 bits are cut into `most` + 3 blocks.  Fingerprints that differ in at most `most` bits
    agree on three of them at least, so they share the key of some choice of three.
    """
    count = most + 3
    cuts = np.linspace(0, 64, count + 1).astype(int)
    masks = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(cuts[:-1], cuts[1:])]
    keys = []
    for number, chosen in enumerate(combinations(masks, 3)):
        mask = sum(chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.xxhash64(F.lit(number), fp.bitwiseAND(F.lit(signed))))
    return F.array(*keys)


def near_links(fps: DataFrame, most: int = 3, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) that span every group of distinct fingerprints within `most` bits; column fp.

    Only keys shared by two or more fingerprints move on.  A key with more than `chunk` of them is
    dealt out over pairs of its chunks, each pair a task's work of its own, so a block that holds a
    third of all fingerprints neither lands in one task nor loses a comparison.
    """
    keyed = fps.select("fp", F.explode(block_keys(F.col("fp"), most)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    mine = F.pmod(F.hash("fp"), F.col("chunks"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.struct(F.least("mine", other).alias("low"), F.greatest("mine", other).alias("high")),
    )
    dealt = (
        keyed.join(shared.select("key", chunks.alias("chunks")), "key")
        .withColumn("mine", mine)
        .select("fp", "key", F.explode(pairs).alias("pair"))
        .select("fp", F.xxhash64("key", "pair.low", "pair.high").alias("block"))
    )
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = dealt.repartition(parts, "block").sortWithinPartitions("block")
    return blocks.mapInArrow(_block_edges(most), "a long, b long").distinct()


def near_groups(docs: DataFrame, shingle: int = 3, most: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id, _text, _root.

    Fingerprint: XXH64 (seed 42) of each run of `shingle` words, repeats included; a bit is set if
    it is set in more than half of them.  Words are runs without ASCII white space with A-Z in lower
    case; a text of fewer words is one shingle, one without any (null, empty) has fingerprint 0 and
    is linked like any other.  Fingerprints link at `most` or fewer differing bits; component_id is
    the smallest doc_id reachable over links, null only if no member has an id.

    Equal fingerprints are one point of the join, whatever their number.  Repeated rows and null ids
    are rows of their own; an empty table gives an empty result; other columns are not read.
    """
    marked = stage(fingerprints(docs, shingle, doc_id, text), "simhash")
    points = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-points")
    roots = components(near_links(points, most), "a", "b").select(F.col("node").alias("fp"), "root")
    rooted = points.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stage(rooted, "simhash-roots")
    smallest = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-smallest")
    of_point = stage(rooted.join(smallest, "root"), "simhash-components").select("fp", "component_id", "root")
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return marked.join(of_point, "fp").select("doc_id", fingerprint, "component_id", "_text", F.col("root").alias("_root"))


def keep_one(docs: DataFrame, shingle: int = 3, most: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, with all its columns: the one with the smallest id.

    Of rows repeated with that id, the one with the lowest hash of its text stays, and of wholly
    equal ones any.  A group whose members all lack an id keeps one row likewise.
    """
    groups = near_groups(docs, shingle, most, doc_id, text)
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    texts = first.groupBy("_root", "doc_id", "_text").agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.struct("_text", "n")).alias("k")
    kept = texts.groupBy("_root", "doc_id").agg(least).select(F.col("doc_id").alias("_k_id"), "k.*")
    kept = stage(kept, "simhash-kept")

    def rows_of(part: DataFrame) -> DataFrame:
        same = docs[doc_id].eqNullSafe(part["_k_id"]) & (F.xxhash64(docs[text]) == part["_text"])
        return docs.join(part, same, "left_semi")

    # equal rows are rare, and folding them moves the texts once more: only they take that path
    repeated = stage(kept.where("n > 1"), "simhash-repeated")
    return rows_of(kept.where("n = 1")).unionByName(rows_of(repeated).dropDuplicates([doc_id, text]))
