"""Embedding near-dedup: collision counts over sorted one-dimensional projections."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.blocks import bounds, key_runs, star_edges
from ordermill.llm.common import stage
from ordermill.llm.components import components

CELL = 1.5  # cell width, in units of a projection's spread
COUNTED = 16  # sorted projections whose window collisions are counted
STEP = 2.0**-12  # values on these projections travel as multiples of it, in 16 bits
CHUNK = 2048  # vectors of one cell that a task compares at a time with as many others
COUNTERS = 1 << 20  # pairs whose collisions a task counts at a time
PAIRS = 1 << 14  # pairs verified at a time


PLACE = ["point", "block", "table", "low", "high", "mine"]


@dataclass(frozen=True)
class Plan:
    """How to look for neighbours; made by `calibrated`."""

    cosine: float
    width: int  # projections that make a cell
    tables: int  # cells of each vector
    window: float  # half width of the query-centred window
    least: int  # collisions of COUNTED that make a candidate


def _same_cell(distance: float) -> float:
    """Chance that two points at this distance fall into one cell of width CELL of a projection."""
    c = CELL / distance
    tail = math.erfc(c / math.sqrt(2))
    return 1 - tail - 2 / (math.sqrt(2 * math.pi) * c) * (1 - math.exp(-c * c / 2))


def calibrated(cosine: float, points: int, recall: float) -> Plan:
    """The plan for `points` vectors under one label that finds a pair at `cosine` with chance `recall`.

    Unit vectors at cosine c are sqrt(2 - 2c) apart, and so are their projections, times a standard
    normal.  Cells are narrowed until unrelated vectors (sqrt 2 apart) seldom share one, tables are
    added until a pair at the threshold shares one with half of the allowed misses, and the least
    collision count leaves the other half.  Closer pairs are found more surely.
    """
    near = math.sqrt(max(2 - 2 * cosine, 1e-6))
    missed = (1 - recall) / 2
    width = max(1, math.ceil(math.log(max(points, 2)) / -math.log(_same_cell(math.sqrt(2)))))
    shared = _same_cell(near) ** width
    tables = max(1, math.ceil(math.log(missed) / math.log1p(-shared)))
    hit = math.erf(2.5 / math.sqrt(2))  # windows reach 2.5 spreads
    least, chance = COUNTED, hit**COUNTED
    while chance < 1 - missed:
        least -= 1
        chance += math.comb(COUNTED, least) * hit**least * (1 - hit) ** (COUNTED - least)
    return Plan(cosine, width, tables, 2.5 * near, least)


def _directions(dim: int, count: int, purpose: int) -> np.ndarray:
    return np.random.default_rng([20240501, dim, count, purpose]).standard_normal((dim, count))


def cells_of(units: np.ndarray, plan: Plan) -> np.ndarray:
    """The cell of each unit vector in each table, as a 32-bit hash: rows x tables.

    Cells that share a hash are one cell to every step that follows.
    """
    count = plan.width * plan.tables
    shift = np.random.default_rng([7, count]).uniform(0, CELL, count)
    steps = np.floor((units @ _directions(units.shape[1], count, 0) + shift) / CELL).astype(np.int64)
    steps = steps.reshape(len(units), plan.tables, plan.width)
    mixed = np.zeros(steps.shape[:2], dtype=np.int64)
    for k in range(plan.width):
        mixed = (mixed ^ (mixed >> 29)) * np.int64(-7046029254386353131) + steps[:, :, k]
    return (mixed >> 32).astype(np.int32)


def shown_of(units: np.ndarray) -> np.ndarray:
    """The counted projections of each unit vector, in steps: rows x COUNTED.  Far values are clipped, which only adds collisions."""
    steps = np.floor(units @ _directions(units.shape[1], COUNTED, 1) / STEP)
    return np.clip(steps, -32768, 32767).astype(np.int16)


def _lists(values: np.ndarray) -> pa.ListArray:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(values.ravel()))


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    return lists.combine_chunks().flatten().to_numpy().reshape(-1, width)


def _units(vectors: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat values scaled to unit length per vector, and their offsets."""
    offsets = vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(offsets)
    flat = flat / np.repeat(np.maximum.reduceat(np.abs(flat), offsets[:-1]), lengths)
    return flat / np.repeat(np.sqrt(np.add.reduceat(flat * flat, offsets[:-1])), lengths), offsets


def _with_cells(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, offsets = _units(batch.column("vector"))
            lengths = np.diff(offsets)
            cells = np.empty((len(lengths), plan.tables), dtype=np.int32)
            shown = np.empty((len(lengths), COUNTED), dtype=np.int16)
            for dim in np.unique(lengths):
                of_dim = np.flatnonzero(lengths == dim)
                units = flat[(offsets[of_dim, None] + np.arange(dim)).ravel()].reshape(-1, dim)
                cells[of_dim], shown[of_dim] = cells_of(units, plan), shown_of(units)
            unit = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column("point"), batch.column("label_key"), unit, batch.column("copies"), _lists(shown), _lists(cells)],
                ["point", "label_key", "unit", "copies", "shown", "cells"],
            )

    return run


def colliding(shown: np.ndarray, blocks: np.ndarray, plan: Plan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs a < b of rows of one block that collide on at least `plan.least` projections.

    Rows come block after block.  Each projection is sorted once; a row's window is the run of the
    sorted values around its own, and every other row in it gets a collision with the row.
    """
    cuts = bounds(blocks)
    sizes = np.diff(cuts)
    first, size, nth = (np.repeat(x, sizes) for x in (cuts[:-1], sizes, np.arange(len(sizes))))
    window = math.ceil(plan.window / STEP) + 1
    apart = (1 << 16) + 2 * window  # no window reaches into the next block
    projections = []
    for k in range(shown.shape[1]):
        line = nth * apart + shown[:, k]
        order = np.argsort(line, kind="stable")
        low = np.searchsorted(line[order], line - window, side="left")
        high = np.searchsorted(line[order], line + window, side="right")
        projections.append((order, low, high - low))
    before = np.concatenate(([0], np.cumsum(size)))
    top = 0
    while top < len(shown):
        end = max(top + 1, int(np.searchsorted(before, before[top] + COUNTERS, side="right")) - 1)
        rows, base = slice(top, end), before[top:end] - before[top]
        counts = np.zeros(before[end] - before[top], dtype=np.uint8)
        for order, low, length in projections:
            ends = np.cumsum(length[rows])
            place = np.arange(ends[-1]) + np.repeat(low[rows] - ends + length[rows], length[rows])
            # a projection shows each other row once to a row, so no counter is named twice
            counts[order[place] + np.repeat(base - first[rows], length[rows])] += 1
        passed = np.flatnonzero(counts >= plan.least)
        row = np.searchsorted(base, passed, side="right") - 1
        a, b = top + row, first[top + row] + passed - base[row]
        yield a[b > a], b[b > a]
        top = end


def _candidates(rows: pa.Table, plan: Plan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Colliding pairs of the blocks in `rows` that no earlier table and no other block counts."""
    cells, shown = _matrix(rows.column("cells"), plan.tables), _matrix(rows.column("shown"), COUNTED)
    table, low, high, mine = (rows.column(c).to_numpy() for c in ("table", "low", "high", "mine"))
    for a, b in colliding(shown, rows.column("block").to_numpy(), plan):
        here = (low[a] == high[a]) | (mine[a] != mine[b])  # pairs inside a chunk belong to the block of that chunk alone
        a, b = a[here], b[here]
        for k in range(0, len(a), PAIRS):
            i, j = a[k : k + PAIRS], b[k : k + PAIRS]
            same = cells[i] == cells[j]
            first = same.argmax(axis=1)
            new = same[np.arange(len(i)), first] & (first == table[i])
            yield i[new], j[new]


def _block_candidates(plan: Plan):
    """The members of each block that are in a candidate pair there, without their vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, "block"):
            named = np.zeros(rows.num_rows, dtype=bool)
            for a, b in _candidates(rows, plan):
                named[a] = named[b] = True
            yield from rows.select(PLACE).filter(pa.array(named)).combine_chunks().to_batches()

    return run


def _cosines(values: np.ndarray, starts: np.ndarray, dims: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of the unit vectors of each pair, whose lengths are equal."""
    result = np.empty(len(a))
    for dim in np.unique(dims[a]):
        chosen = np.flatnonzero(dims[a] == dim)
        across = np.arange(dim)
        left, right = (values[starts[x[chosen], None] + across] for x in (a, b))
        result[chosen] = np.einsum("ij,ij->i", left, right)
    return result


def _block_links(plan: Plan):
    """For each vector with links in a block: the vectors it links to there, and a spanning link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, "block"):
            flat = rows.column("unit").combine_chunks()
            dims = np.diff(flat.offsets.to_numpy())
            values, starts = flat.flatten().to_numpy(), flat.offsets.to_numpy() - flat.offsets[0].as_py()
            copies, label = rows.column("copies").to_numpy(), rows.column("label_key").to_numpy()
            links, root_of = np.zeros(len(dims), dtype=np.int64), np.arange(len(dims))
            for a, b in _candidates(rows, plan):
                alike = (label[a] == label[b]) & (dims[a] == dims[b])  # two keys may share a 64-bit hash
                a, b = a[alike], b[alike]
                linked = _cosines(values, starts, dims, a, b) >= plan.cosine
                a, b = a[linked], b[linked]
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                # links so far are kept as a star; the new ones join its roots
                member, root = star_edges(len(dims), np.concatenate((root_of, a)), np.concatenate((np.arange(len(dims)), b)))
                root_of = np.arange(len(dims))
                root_of[member] = root
            linked = np.flatnonzero(links)
            points = rows.column("point").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [points.take(pa.array(linked)), pa.array(links[linked]), points.take(pa.array(root_of[linked]))],
                ["point", "links", "root"],
            )

    return run


def _valid(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.98,
    recall: float = 0.99,
    chunk: int = CHUNK,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept.

    Vectors of one label and length link at `cosine` or more, in double precision.  n_links counts
    the other vectors linked directly, component_id is the smallest vec_id reachable, kept says
    that it is the row's own.

    Equal vectors of a label are one point with a count.  Random projections are cut into cells;
    points that share a cell of some table meet in a block.  There further projections are sorted,
    and points in each other's windows on enough of them are candidates: until then a point travels
    as 16 numbers of 16 bits and its cells.  Only members of candidate pairs send their vectors to
    the block where the pair counts, the first that joins it, and are verified.  `calibrated` derives cells,
    tables and counts from the largest label and `recall`, the chance of finding a pair right at the
    threshold.  A cell of more than `chunk` points is dealt out over pairs of chunks: all are
    compared, none in one task.

    Vectors that are null, empty, zero, hold null or non-finite components, or have no label link
    with nothing: n_links 0 and their own vec_id.  Repeated rows link with each other.  A null id is
    never a component_id unless no member has an id, and then kept is true.  An empty table gives an
    empty result; other columns are not read.
    """
    doubles = F.col(embedding).cast("array<double>")
    rows = vectors.select(
        F.col(vec_id).alias("vec_id"),
        F.when(_valid(doubles, F.col(label)), doubles).alias("vector"),
        F.xxhash64(label).alias("label_key"),
    )
    point = F.concat(F.hex(F.xxhash64("label_key", "vector")), F.lit("-"), F.hex(F.hash("vector", "label_key")))
    rows = rows.withColumn("point", F.when(F.col("vector").isNotNull(), point))
    valid = rows.where("point is not null")
    points = stage(
        valid.groupBy("point", "label_key").agg(
            F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")
        ),
        "vector-points",
    )
    largest = points.groupBy("label_key").count().agg(F.max("count")).first()[0] or 0
    plan = calibrated(cosine, largest, recall)
    celled = points.drop("least").mapInArrow(
        _with_cells(plan), "point string, label_key long, unit array<double>, copies long, shown array<short>, cells array<int>"
    )
    celled = stage(celled, "vector-cells")

    keyed = celled.select("point", "label_key", F.size("unit").alias("dim"), F.posexplode("cells").alias("table", "cell"))
    keyed = keyed.select("point", "table", F.xxhash64("label_key", "dim", "table", "cell").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / chunk).cast("int").alias("chunks")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.struct(F.least("mine", other).alias("low"), F.greatest("mine", other).alias("high")),
    )
    dealt = (
        keyed.join(shared.select("key", chunks), "key")
        .withColumn("mine", F.pmod(F.hash("point"), F.col("chunks")))
        .select("point", "table", "key", "mine", F.explode(pairs).alias("pair"))
        .select("point", "table", "mine", "pair.low", "pair.high", F.xxhash64("key", "pair.low", "pair.high").alias("block"))
    )
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def in_blocks(places: DataFrame, *columns: str) -> DataFrame:
        return places.join(celled.select("point", *columns), "point").repartition(parts, "block").sortWithinPartitions("block")

    place = "point string, block long, table int, low int, high int, mine int"
    named = stage(in_blocks(dealt, "shown", "cells").mapInArrow(_block_candidates(plan), place), "vector-candidates")
    found = in_blocks(named, "shown", "cells", "label_key", "unit", "copies").mapInArrow(
        _block_links(plan), "point string, links long, root string"
    )
    found = stage(found, "vector-links")

    counts = found.groupBy("point").agg(F.sum("links").alias("links"))
    roots = components(found.select("point", "root"), "point", "root").select(F.col("node").alias("point"), F.col("root"))
    rooted = points.select("point", "copies", "least").join(counts, "point", "left").join(roots, "point", "left")
    rooted = stage(rooted.withColumn("root", F.coalesce("root", "point")), "vector-roots")
    smallest = stage(rooted.groupBy("root").agg(F.min("least").alias("component")), "vector-smallest")
    n_links = F.col("copies") - 1 + F.coalesce("links", F.lit(0))
    of_point = rooted.join(smallest, "root").select("point", n_links.alias("links"), "component")
    joined = rows.drop("vector", "label_key").join(stage(of_point, "vector-components"), "point", "left")
    component = F.when(F.col("point").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
