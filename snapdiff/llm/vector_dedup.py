"""Embedding near-dedup: spherical k-means cells, blocked cosine products, one vector kept per group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import whole_groups
from .common import small, staged
from .components import components

SIMILARITY = 0.9     # fixed by the contract
CELL = 4096          # different vectors a cell should hold
BLOCK = 4096         # vectors compared at once; a larger cell becomes pairs of blocks
SAMPLE = 1 << 16     # vectors, about, on which the cells are fitted; every vector is assigned and compared
LEAST_SAMPLE = 16    # sampled vectors per cell
TURNS = 5            # turns of k-means
_STRIP = 512         # rows of a product held at a time
_CLOSE = 1e-9        # products this near the threshold are measured again, term by term
_GROUP = ["dim", "cell", "lo", "hi"]


def _vector() -> Column:
    """The vector in doubles, negative zeros made positive; null if it takes no part."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite & F.exists(v, lambda x: x != 0), F.transform(v, lambda x: x + F.lit(0.0)))


def _key(vector: Column) -> Column:
    """A 128-bit name that equal vectors share."""
    return F.unhex(F.md5(F.array_join(vector.cast("array<string>"), ",")))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The vectors of a binary column, which have one length."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times powers of two, so that squares of very large or small components stay finite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _units(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """`key, vec, dim, n, first`: every different vector that takes part, its rows and their smallest vec_id."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["vec"]
            values = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8")
            cuts = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())].tolist()
            vec = [values[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(vec, pa.binary()), pa.array(np.diff(cuts).astype(np.int32)),
                                              batch["n"], batch["first"]], ["key", "vec", "dim", "n", "first"])

    once = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), _vector().alias("vec")).where(F.col("vec").isNotNull())
    once = once.groupBy(_key(F.col("vec")).alias("key")).agg(
        F.first("vec").alias("vec"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    return once.mapInArrow(pack, "key binary, vec binary, dim int, n long, first long")


def spherical_kmeans(x: np.ndarray, k: int, turns: int = TURNS) -> np.ndarray:
    """Unit centroids of unit vectors. An empty cell keeps its centroid."""
    centroids = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(turns):
        cell = _nearest(x, centroids)[0]
        for c in np.unique(cell):
            total = x[cell == c].sum(axis=0)
            if np.abs(total).max() > 1e-12:
                centroids[c] = _units(total[None])[0]
    return centroids


def _nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each unit vector, and its cosine to that cell's centroid."""
    cells, cosines = [], []
    for part in np.array_split(x, 1 + len(x) * len(centroids) // (1 << 22)):
        products = part @ centroids.T
        cells.append(products.argmax(axis=1))
        cosines.append(products[np.arange(len(part)), cells[-1]])
    return np.concatenate(cells), np.concatenate(cosines)


def fit_cells(nodes: DataFrame, cell: int = CELL) -> dict[int, np.ndarray]:
    """Centroids for each length of vector, fitted on a sample drawn by key.

    A length that the sample lacks has one cell. At most SAMPLE / LEAST_SAMPLE
    centroids reach the driver's result, whatever the table's size.
    """
    rows = nodes.count()
    drawn = F.pmod(F.xxhash64("key"), F.lit(max(rows, SAMPLE))) < SAMPLE
    held = sorted((r.dim, bytes(r.key), bytes(r.vec)) for r in nodes.where(drawn).select("dim", "key", "vec").collect())
    share = max(1.0, rows / SAMPLE)
    found = {}
    for dim in sorted({d for d, _, _ in held}):
        x = _units(np.frombuffer(b"".join(v for d, _, v in held if d == dim), "<f8").reshape(-1, dim))
        found[dim] = spherical_kmeans(x, max(1, min(int(np.ceil(len(x) * share / cell)), len(x) // LEAST_SAMPLE)))
    return found


def visited(x: np.ndarray, own: np.ndarray, cosine: np.ndarray, centroids: np.ndarray, radius: np.ndarray,
            similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors must be compared in which earlier cells, besides their own: rows and cells.

    A vector y of cell b has a partner in cell a < b only if it can be turned by the
    angle of the threshold until it is as near to a's centroid as to b's, that is
    if its distance to the plane between both centroids is at most the angle's sine;
    and only if its angle to a's centroid is at most a's radius and that angle.
    """
    angle = np.arccos(similarity)
    rows, cells = [], []
    size = 1 + (1 << 22) // len(centroids)
    for at in range(0, len(x), size):
        part = slice(at, at + size)
        products = x[part] @ centroids.T
        apart = np.sqrt(np.maximum(2 - 2 * centroids[own[part]] @ centroids.T, 0))
        near = cosine[part, None] - products <= np.sin(angle) * apart + 1e-9
        near &= np.arccos(np.clip(products, -1, 1)) <= radius + angle + 1e-7
        near &= np.arange(len(centroids)) < own[part, None]
        row, cell = np.nonzero(near)
        rows.append(at + row)
        cells.append(cell)
    return np.concatenate(rows), np.concatenate(cells)


def _assigned(nodes: DataFrame, centroids: dict[int, np.ndarray]) -> DataFrame:
    """`dim, cell, cosine, key, n, vec`: every vector in its own cell."""
    shared = nodes.sparkSession.sparkContext.broadcast(centroids)  # at most SAMPLE / LEAST_SAMPLE vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                cell, cosine = np.zeros(len(part), np.int64), np.zeros(len(part))
                if dim in shared.value:
                    cell, cosine = _nearest(_units(_matrix(part["vec"])), shared.value[dim])
                yield pa.RecordBatch.from_arrays([part["dim"], pa.array(cell.astype(np.int32)), pa.array(cosine), part["key"], part["n"], part["vec"]],
                                                 ["dim", "cell", "cosine", "key", "n", "vec"])

    return nodes.select("key", "vec", "dim", "n").mapInArrow(run, "dim int, cell int, cosine double, key binary, n long, vec binary")


def _visits(homes: DataFrame, centroids: dict[int, np.ndarray], radii: dict[tuple[int, int], float], similarity: float, whole: bool) -> DataFrame:
    """`dim, cell, key, n, vec` of every visit of a vector to an earlier cell, or only counts of them by task."""
    shared = homes.sparkSession.sparkContext.broadcast(
        {d: (c, np.array([radii.get((d, i), -10.0) for i in range(len(c))])) for d, c in centroids.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in shared.value:
                    continue
                part = batch.filter(pa.array(dims == dim))
                rows, cells = visited(_units(_matrix(part["vec"])), part["cell"].to_numpy(), part["cosine"].to_numpy(), *shared.value[dim], similarity)
                if not whole:
                    cells, n = np.unique(cells, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), dim, np.int32)), pa.array(cells.astype(np.int32)), pa.array(n)], ["dim", "cell", "n"])
                    continue
                for at in range(0, len(rows), BLOCK):
                    taken = part.take(pa.array(rows[at:at + BLOCK]))
                    yield pa.RecordBatch.from_arrays([taken["dim"], pa.array(cells[at:at + BLOCK].astype(np.int32)), taken["key"], taken["n"], taken["vec"]],
                                                     ["dim", "cell", "key", "n", "vec"])

    return homes.mapInArrow(run, "dim int, cell int, key binary, n long, vec binary" if whole else "dim int, cell int, n long")


def _dealt(homes: DataFrame, visits: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows `dim, cell, lo, hi, block, key, n, vec`; any two that must be compared share a group of two blocks.

    `sizes` holds the blocks of homes (`homes`) and of visits (`guests`) of every cell.
    """
    block = F.pmod(F.xxhash64("key"), F.col("homes")).cast("int")
    with_homes = F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda j: F.struct(
        F.least(block, j).alias("lo"), F.greatest(block, j).alias("hi")))
    with_guests = F.when(F.col("guests") > 0, F.transform(F.sequence(F.lit(1), F.col("guests")), lambda j: F.struct(
        block.alias("lo"), (-j).alias("hi")))).otherwise(F.array().cast("array<struct<lo:int,hi:int>>"))
    guest = (-1 - F.pmod(F.xxhash64("key"), F.col("guests"))).cast("int")
    rows = ("block", "key", "n", "vec")
    own = homes.join(sizes, ["dim", "cell"]).withColumn("block", block).select(
        "dim", "cell", *rows, F.inline(F.concat(with_homes, with_guests)))
    come = visits.join(sizes, ["dim", "cell"]).withColumn("block", guest).select("dim", "cell", *rows, F.inline(
        F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda j: F.struct(j.alias("lo"), F.col("block").alias("hi")))))
    return own.select(*_GROUP, *rows).union(come.select(*_GROUP, *rows))


def _linked(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs of a strip reach the similarity."""
    products = a @ b.T
    found = products >= similarity
    for i, j in zip(*np.nonzero(np.abs(products - similarity) <= _CLOSE)):
        x, y = raw_a[i], raw_b[j]
        found[i, j] = float((x * y).sum()) / float(np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())) >= similarity
    return found


def _compared(groups: DataFrame, similarity: float) -> DataFrame:
    """`u, n` (rows that u links with, by group) and `u, v` (links that join what all links join)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, _GROUP):
            keys = np.array([table[k].to_numpy() for k in _GROUP])
            starts = np.flatnonzero(np.r_[True, np.any(keys[:, 1:] != keys[:, :-1], axis=0)])
            block = np.asarray(table["block"].to_numpy())
            for at, to in zip(starts.tolist(), [*starts[1:].tolist(), len(block)]):
                if to - at < 2:
                    continue
                x, n = _matrix(table["vec"].slice(at, to - at)), table["n"].to_numpy()[at:to]
                first, second = _sides(block[at:to], *keys[2:, at])
                counts, links = compare(x, n, first, second, similarity)
                names = table["key"].slice(at, to - at).combine_chunks()
                hit = np.flatnonzero(counts)
                if len(hit):
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(hit)), pa.nulls(len(hit), pa.binary()), pa.array(counts[hit])], ["u", "v", "n"])
                if len(links):
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(links[:, 0])), names.take(pa.array(links[:, 1])), pa.array(np.zeros(len(links), np.int64))], ["u", "v", "n"])

    return groups.mapInArrow(run, "u binary, v binary, n long")


def _sides(block: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of both blocks of a group; one block is compared with itself."""
    return (np.arange(len(block)),) * 2 if lo == hi else (np.flatnonzero(block == lo), np.flatnonzero(block == hi))


def compare(x: np.ndarray, n: np.ndarray, first: np.ndarray, second: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows each vector links with, and links, at most one fewer than vectors, that join the linked ones.

    Products are made a strip at a time; of each strip only links that join groups not yet joined are kept.
    """
    units, x = _units(x), _scaled(x)
    counts, group, links = np.zeros(len(x), np.int64), np.arange(len(x)), []
    itself = first is second
    for at in range(0, len(first), _STRIP):
        rows = first[at:at + _STRIP]
        others = second[at:] if itself else second
        found = _linked(units[rows], units[others], x[rows], x[others], similarity)
        if itself:
            found &= np.arange(len(others)) > np.arange(len(rows))[:, None]  # each pair once
        if not found.any():
            continue
        counts[rows] += found @ n[others]
        counts[others] += n[rows] @ found
        for i in np.flatnonzero(found.any(axis=1)).tolist():
            own, near = group[rows[i]], others[found[i]]
            apart, where = np.unique(group[near], return_index=True)
            new = apart != own
            if new.any():
                links.extend((rows[i], j) for j in near[where[new]].tolist())
                group[np.isin(group, apart[new])] = own
    return counts, np.array(links, np.int64).reshape(-1, 2)


def link_vectors(vectors: DataFrame, similarity: float = SIMILARITY, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """`key, n_links, component_id` of the vectors that equal or link with another row."""
    spark = vectors.sparkSession
    nodes = staged(distinct_vectors(vectors), "vectors")
    centroids = fit_cells(nodes, cell)
    homes = staged(_assigned(nodes, centroids), "cells")
    held = homes.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("cosine").alias("least")).collect()  # a row per cell
    radii = {(r.dim, r["cell"]): float(np.arccos(np.clip(r.least, -1, 1))) for r in held}
    guests = {(r.dim, r["cell"]): r.n for r in _visits(homes, centroids, radii, similarity, False)
              .groupBy("dim", "cell").agg(F.sum("n").alias("n")).collect()}
    sizes = [(r.dim, r["cell"], -(-r.n // block), -(-guests.get((r.dim, r["cell"]), 0) // block)) for r in held]
    sizes = spark.createDataFrame(sizes, "dim int, cell int, homes int, guests int")
    groups = _dealt(homes.drop("cosine"), _visits(homes, centroids, radii, similarity, True), small(sizes))
    found = staged(_compared(groups.repartition(*_GROUP).sortWithinPartitions(*_GROUP), similarity), "links")
    counts = found.where("v IS NULL").groupBy(F.col("u").alias("key")).agg(F.sum("n").alias("links"))
    roots = components(found.where("v IS NOT NULL").select("u", "v")).select(F.col("node").alias("key"), "root")
    several = nodes.select("key", "n", "first").join(counts, "key", "left").where("n > 1 OR links IS NOT NULL").join(roots, "key", "left")
    several = staged(several.select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "first",
                                    F.coalesce("root", "key").alias("root")), "several")
    least = several.groupBy("root").agg(F.min("first").alias("component_id"))
    return several.join(least, "root").select("key", "n_links", "component_id")


def dedup_vectors(vectors: DataFrame, similarity: float = SIMILARITY, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """`vectors` with `n_links`, `component_id` and `kept`; existing columns of these names are replaced.

    Two rows link if the cosine of their vectors, in doubles, is `similarity`
    (positive) or more; no such pair is lost. `n_links` counts the other rows a row
    links with, `component_id` is the smallest vec_id reachable by links, itself
    included, and a row is kept if it has that id. Equal vectors are compared once.
    Rows whose vector is null, empty or zero or holds null or non-finite components link
    with nothing; vectors of different lengths do not link. Rows repeated with
    one vec_id are rows like any other and are kept or not together. A row without
    vec_id counts as a link; it names no component and is kept only in one that has no id.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in vectors.columns]).alias("row")
    rows = vectors.select(row, _key(_vector()).alias("key"))
    found = small(staged(link_vectors(vectors, similarity, cell, block), "labels"))
    alone = F.col("row.vec_id").cast("long")
    labelled = rows.where("key IS NOT NULL").join(found, "key", "left").select(
        "row", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), alone).otherwise(F.col("component_id")).alias("component_id"))
    invalid = rows.where("key IS NULL").select("row", F.lit(0).cast("long").alias("n_links"), alone.alias("component_id"))
    added = ("n_links", "component_id", "kept")
    kept = labelled.union(invalid).withColumn("kept", alone.eqNullSafe(F.col("component_id")))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in vectors.columns if c.lower() not in added], *added)
