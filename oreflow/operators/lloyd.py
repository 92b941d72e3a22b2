"""Lloyd's k-means with random starting points and a fixed number of steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions.priority import priority
from oreflow.session import materialise

# Fixed value: seed of the starting points.
SEED = 20181031
# Totals by cell as they travel.
PACKED = "part int, cells binary, totals binary"
# Columns of a block of points as it is stored.
BLOCK = ["sizes", "idx", "val"]
# Cells of a block, about; few enough for the caches of a core.
BLOCK_CELLS = 1 << 16
# Sums that a task holds before it adds them up, at least.
HELD = 1 << 20
# Coordinates that a task holds in one table, at most: those of some centroids at all dimensions, or at a batch's own if there are more.
DENSE = 1 << 23


class Centroids:
    """``k`` centroids by their cells that are not zero, in order of cluster, then dimension.

    There are at most ``k`` times the number of dimensions, both parameters of the run, and
    at most as many as the points occupy. A task makes tables of ``DENSE`` of them only.
    """

    def __init__(self, shape: tuple[int, int], dim: np.ndarray, cluster: np.ndarray, value: np.ndarray):
        order = np.lexsort((dim, cluster))
        self.shape, self.dim, self.cluster, self.value = shape, dim[order], cluster[order], value[order]
        self.table = None

    @classmethod
    def of(cls, centroids: np.ndarray | Centroids) -> Centroids:
        if isinstance(centroids, Centroids):
            return centroids
        cluster, dim = np.nonzero(centroids)
        return cls(centroids.shape, dim, cluster, centroids[cluster, dim])

    def dense(self) -> np.ndarray:
        out = np.zeros(self.shape)
        out[self.cluster, self.dim] = self.value
        return out

    def norms(self) -> np.ndarray:
        return np.bincount(self.cluster, self.value * self.value, self.shape[0])

    def groups(self, dims: np.ndarray | None, group: int) -> Iterator[tuple[int, np.ndarray]]:
        """The coordinates of ``group`` centroids after the other, one row per dimension: of ``dims``, given in ascending order, or of all."""
        if dims is None and group >= self.shape[0] and self.table is not None:
            yield 0, self.table
            return
        for first in range(0, self.shape[0], group):
            begin, end = np.searchsorted(self.cluster, (first, first + group))
            place, cluster, value = self.dim[begin:end], self.cluster[begin:end] - first, self.value[begin:end]
            if dims is not None:
                found = np.isin(place, dims)
                place, cluster, value = np.searchsorted(dims, place[found]), cluster[found], value[found]
            table = np.zeros((self.shape[1] if dims is None else len(dims), min(group, self.shape[0] - first)))
            table[place, cluster] = value
            if dims is None and group >= self.shape[0]:
                self.table = table
            yield first, table


def _start(points: DataFrame, key: str, k: int, dims: int, seed: int) -> Centroids:
    chosen = points.orderBy(priority(seed, F.col(key)), key).limit(k).collect()
    dim = [np.asarray(p["idx"] if "idx" in points.columns else range(len(p["val"])), dtype=np.int64) for p in chosen]
    value = [np.asarray(p["val"], dtype=np.float64) for p in chosen]
    cluster = np.repeat(np.arange(len(chosen)), [len(x) for x in dim])
    none = [np.zeros(0)]
    return Centroids((len(chosen), dims), np.concatenate(dim or none).astype(np.int64), cluster, np.concatenate(value or none))


def starting_points(points: DataFrame, key: str, k: int, dims: int, seed: int = SEED) -> np.ndarray:
    """``k`` distinct points in the order of their hashed priority.

    ``points`` is (key, val) for dense or (key, idx, val) for sparse vectors.
    """
    return _start(points, key, k, dims, seed).dense()


class _Block:
    """Some points: the number of cells of each, and of each cell its dimension and its value."""

    def __init__(self, sizes: np.ndarray, idx: np.ndarray, val: np.ndarray):
        self.sizes, self.idx, self.val = sizes, idx, val
        self.row = np.repeat(np.arange(len(sizes)), sizes)

    @classmethod
    def stored(cls, sizes: bytes, idx: bytes, val: bytes) -> _Block:
        return cls(np.frombuffer(sizes, np.int32), np.frombuffer(idx, np.int32).astype(np.int64), np.frombuffer(val))

    def columns(self) -> list[bytes]:
        return [self.sizes.astype(np.int32).tobytes(), self.idx.astype(np.int32).tobytes(), self.val.tobytes()]

    def per_row(self, values: np.ndarray) -> np.ndarray:
        """Sums by row, one cell after the other, so that a point that is a centroid has the distance 0."""
        return np.bincount(self.row, values, len(self.sizes))

    def products(self, place: np.ndarray, table: np.ndarray) -> Iterator[np.ndarray]:
        """The product of each row with one column of ``table`` after the other; ``place`` tells the rows of its cells there."""
        cells = table.take(place, axis=0)
        cells *= self.val[:, None]
        return (self.per_row(column) for column in cells.T)


class _Batch:
    """The blocks of one Arrow batch. Each cell has the place of its dimension, which is the dimension itself unless there are too many."""

    def __init__(self, blocks: list[_Block], dims: int):
        self.blocks, self.places, self.dims = blocks, [block.idx for block in blocks], None
        if dims > DENSE:
            self.dims, place = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *self.places]), return_inverse=True)
            self.places = np.split(place, np.cumsum([len(block.idx) for block in blocks])[:-1])
        self.width = dims if self.dims is None else len(self.dims)
        self.group = max(1, DENSE // max(self.width, 1))

    def nearest(self, centroids: Centroids) -> list[tuple[np.ndarray, np.ndarray]]:
        """Cluster and squared distance per row of each block; the lowest cluster wins a tie."""
        own = [block.per_row(block.val * block.val) for block in self.blocks]
        found = [(np.zeros(len(x), dtype=np.int64), np.full(len(x), np.inf)) for x in own]
        norms = centroids.norms()
        for first, table in centroids.groups(self.dims, self.group):
            for block, place, square, (best, least) in zip(self.blocks, self.places, own, found, strict=True):
                for i, product in enumerate(block.products(place, table), first):
                    distance = square - 2 * product + norms[i]
                    nearer = distance < least
                    best[nearer], least[nearer] = i, distance[nearer]
        return [(best, np.maximum(least, 0.0)) for best, least in found]

    def sums(self, best: list[np.ndarray], k: int, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``cluster * dimensions + dimension`` and total of every sum that is not zero."""
        for first in range(0, k, self.group):
            totals = np.zeros(min(self.group, k - first) * self.width)
            for block, place, x in zip(self.blocks, self.places, best, strict=True):
                cell, val = (x[block.row] - first) * self.width + place, block.val
                if self.group < k:
                    mine = (cell >= 0) & (cell < len(totals))
                    cell, val = cell[mine], val[mine]
                np.add.at(totals, cell, val)
            found = np.flatnonzero(totals)
            cluster, place = found // max(self.width, 1) + first, found % max(self.width, 1)
            yield cluster * dims + (place if self.dims is None else self.dims[place]), totals[found]


def _cut(batch: pa.RecordBatch, dims: int) -> list[_Block]:
    """The vectors of one Arrow batch in blocks, in order.

    A null vector, or a dense one that has not all dimensions, is an error.
    """
    values = batch.column("val")
    lengths = np.diff(values.offsets.to_numpy())
    if values.null_count or ("idx" not in batch.schema.names and (lengths != dims).any()):
        raise ValueError(f"a vector is null or has not {dims} dimensions")
    val = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if "idx" in batch.schema.names:
        idx = batch.column("idx").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    else:
        idx = np.tile(np.arange(dims), batch.num_rows)
    ends = np.cumsum(lengths)
    rows = [*np.flatnonzero(np.diff(np.maximum(ends - 1, 0) // BLOCK_CELLS, prepend=-1)).tolist(), len(lengths)]
    cells = [0, *(int(ends[row - 1]) for row in rows[1:])]
    return [_Block(lengths[rows[i] : rows[i + 1]], idx[cells[i] : cells[i + 1]], val[cells[i] : cells[i + 1]]) for i in range(len(rows) - 1)]


def blocks(points: DataFrame, dims: int) -> DataFrame:
    """``points`` without their keys in the form that steps read: plain bytes, which pass to Python as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [block.columns() for block in _cut(batch, dims)]
            if columns:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*columns, strict=True)], BLOCK)

    vectors = points.select([c for c in points.columns if c in ("idx", "val")])
    return vectors.mapInArrow(run, ", ".join(f"{c} binary" for c in BLOCK))


class _Sums:
    """Totals by cell. What is added is held until it is as much as there is, so each cell is sorted a few times only."""

    def __init__(self):
        self.cells, self.totals, self.held, self.size = np.zeros(0, dtype=np.int64), np.zeros(0), [], 0

    def add(self, cells: np.ndarray, totals: np.ndarray) -> None:
        self.held.append((cells, totals))
        self.size += len(cells)
        if self.size > max(HELD, len(self.cells)):
            self.merge()

    def merge(self) -> None:
        cells, totals = (np.concatenate(x) for x in zip((self.cells, self.totals), *self.held, strict=True))
        self.cells, place = np.unique(cells, return_inverse=True)
        self.totals, self.held, self.size = np.bincount(place, totals, len(self.cells)), [], 0

    def packed(self, parts: int) -> Iterator[pa.RecordBatch]:
        """All totals, in rows of up to ``HELD``, dealt to parts by the hash of their cells."""
        self.merge()
        part = (self.cells * 0x9E3779B1 >> 16) % parts
        for i in range(parts):
            cells, totals = self.cells[part == i], self.totals[part == i]
            for begin in range(0, len(cells), HELD):
                packed = cells[begin : begin + HELD].tobytes(), totals[begin : begin + HELD].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], ["part", "cells", "totals"])


def assign(points: DataFrame, key: str, centroids: np.ndarray | Centroids) -> DataFrame:
    """(key, cluster, distance2): the nearest centroid of each point. No shuffle."""
    dims = centroids.shape[1]
    shared = points.sparkSession.sparkContext.broadcast(Centroids.of(centroids))
    key_type = points.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            best, distance = (np.concatenate(x) for x in zip(*_Batch(_cut(batch, dims), dims).nearest(centres), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(best.astype(np.int32)), pa.array(distance)],
                [key, "cluster", "distance2"],
            )

    return points.mapInArrow(run, f"{key} {key_type}, cluster int, distance2 double")


def step(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One step: the mean of the points nearest to each centroid. A cluster without points keeps its own."""
    return _step(blocks(points, centroids.shape[1]), Centroids.of(centroids)).dense()


def _step(stored: DataFrame, centroids: Centroids) -> Centroids:
    """One step on sparse centroids and the ``blocks`` of points.

    Each task sums its points per cluster first, so the shuffle carries at most one
    number per task, cluster and occupied dimension, packed by parts of the cells, and the
    driver gets the new centroids' cells alone.
    """
    k, dims = centroids.shape
    parts = stored.sparkSession.sparkContext.defaultParallelism
    shared = stored.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        sums, sizes = _Sums(), np.zeros(k)
        for raw in batches:
            batch = _Batch([_Block.stored(*row) for row in zip(*(column.to_pylist() for column in raw.columns), strict=True)], dims)
            best = [x for x, _ in batch.nearest(centres)]
            for cells, totals in batch.sums(best, k, dims) if best else ():
                sums.add(cells, totals)
            for x in best:
                sizes += np.bincount(x, minlength=k)
        # Sizes stand behind all dimensions' cells.
        used = np.flatnonzero(sizes)
        sums.add(k * dims + used, sizes[used])
        yield from sums.packed(parts)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for raw in batches:
            for row in zip(raw.column("cells").to_pylist(), raw.column("totals").to_pylist(), strict=True):
                sums.add(np.frombuffer(row[0], np.int64), np.frombuffer(row[1]))
        yield from sums.packed(1)

    dealt = stored.mapInArrow(run, PACKED).repartition(parts, "part")
    rows = dealt.mapInArrow(add_up, PACKED).select("cells", "totals").collect()
    shared.unpersist()
    cells = np.concatenate([np.zeros(0, dtype=np.int64), *(np.frombuffer(row["cells"], np.int64) for row in rows)])
    total = np.concatenate([np.zeros(0), *(np.frombuffer(row["totals"]) for row in rows)])
    inside = (cells < k * dims) & (total != 0)
    sizes = np.zeros(k)
    sizes[cells[cells >= k * dims] - k * dims] = total[cells >= k * dims]
    cluster, dim, total = cells[inside] // dims, cells[inside] % dims, total[inside]
    stays = sizes[centroids.cluster] == 0
    return Centroids(
        centroids.shape,
        np.concatenate([dim, centroids.dim[stays]]),
        np.concatenate([cluster, centroids.cluster[stays]]),
        np.concatenate([total / np.maximum(sizes[cluster], 1), centroids.value[stays]]),
    )


def fit_sparse(points: DataFrame, key: str, k: int, iterations: int, dims: int, seed: int = SEED) -> Centroids:
    """Centroids after ``iterations + 1`` steps; there is no test for convergence.

    ``points`` are read twice, for the start and for their ``blocks``, which every step scans.
    """
    centroids = _start(points, key, k, dims, seed)
    stored = materialise(blocks(points, dims), "blocks")
    for _ in range(iterations + 1):
        centroids = _step(stored, centroids)
    return centroids


def fit(points: DataFrame, key: str, k: int, iterations: int, dims: int, seed: int = SEED) -> np.ndarray:
    """The centroids of ``fit_sparse`` as a dense table."""
    return fit_sparse(points, key, k, iterations, dims, seed).dense()
