"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells.

Centroids are fitted on a bounded sample; every vector is assigned. A vector belongs to its
nearest cell and is replicated to the cells whose border it is close to. Within a cell, blocks
of vectors are multiplied: a pair that meets in several cells counts in the smallest of them.
A block product returns, for each vector in it, how many others it links and the smallest one
its links reach within the block; pairs are never emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keyed, ship_package
from strata.llm.components import with_components
from strata.session import materialize

COSINE = 0.93
#: Vectors that the centroids are fitted on, at most, and their bytes.
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 64_000_000
#: Vectors of one label and cell that are aimed at, cells at most, rows of one block.
CELL_ROWS = 1_000
MOST_CELLS = 1_024
BLOCK_ROWS = 1_500
ROUNDS = 12
#: A linked pair lies within half the linking radius of the border between its two cells with
#: one of its vectors at least, so that margin finds every pair. A finite number narrows it to
#: so many deviations of a displacement in a random direction, and can lose links.
DEVIATIONS = float("inf")
#: Rounding of the cosines that the margin is compared with.
SLACK = 1e-9


def unit(values: list[float | None] | None) -> np.ndarray | None:
    """The vector at length 1; None for null, empty, zero, or null or non-finite components."""
    if not values or any(value is None for value in values):
        return None
    vector = np.array(values, np.float64)
    if not np.isfinite(vector).all():
        return None
    vector = vector / (np.abs(vector).max() or 1.0)
    length = np.sqrt(vector @ vector)
    return vector / length if length > 0 else None


def _units(rows: DataFrame) -> DataFrame:
    """(_key, label, dim, vector) of the vectors that can link; bytes of doubles."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [unit(values) for values in batch.column(2).to_pylist()]
            keep = pa.array([vector is not None for vector in found], pa.bool_())
            real = [vector for vector in found if vector is not None]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).filter(keep), batch.column(1).filter(keep),
                    pa.array([len(vector) for vector in real], pa.int32()), pa.array(
                        [vector.tobytes() for vector in real], pa.binary()
                    ),
                ],
                names=["_key", "label", "dim", "vector"],
            )

    labelled = rows.where(F.col("label").isNotNull()).select(
        "_key", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>")
    )
    return labelled.mapInArrow(scan, "_key long, label string, dim int, vector binary")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def spherical_kmeans(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centroids by Lloyd rounds on cosines; the start is spread over the sample."""
    cells = min(cells, len(sample))
    centroids = sample[np.linspace(0, len(sample) - 1, cells).astype(int)].copy()
    for _ in range(ROUNDS if cells > 1 else 1):
        nearest = (sample @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(lengths > 1e-12, sums / np.maximum(lengths, 1e-12), centroids)
    return centroids


def _fit(classes: DataFrame, cell_rows: int) -> dict[int, np.ndarray]:
    """Centroids by dimension. The sample is the rows of the smallest hashes."""
    out = {}
    sizes = classes.groupBy("dim", "label").count().groupBy("dim").agg(
        F.sum("count").alias("n"), F.count(F.lit(1)).alias("labels")
    )
    for dim, n, labels in sizes.orderBy("dim").collect():
        rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
        own = classes.where(F.col("dim") == dim)
        few = own.orderBy(F.xxhash64("node"), "node").limit(rows).select("vector")
        sample = _matrix(few.toArrow().column(0), dim)
        cells = max(1, min(MOST_CELLS, -(-n // (cell_rows * labels)), len(sample) // 8 or 1))
        out[dim] = spherical_kmeans(sample, cells)
    return out


def _assigned(
    classes: DataFrame, centroids: dict[int, np.ndarray], cosine: float, deviations: float
) -> DataFrame:
    """Every class in its cells: (label, dim, cell, home, cells, node, n, vector)."""
    schema = "label string, dim int, cell int, home int, cells array<int>, node long, n long, vector binary"
    shared = classes.sparkSession.sparkContext.broadcast(centroids)
    radius = float(np.sqrt(2 - 2 * cosine))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                middle = shared.value[dim]
                cosines = _matrix(own.column(4), dim) @ middle.T
                home = cosines.argmax(1)
                apart = np.sqrt(np.maximum(2 - 2 * middle @ middle.T, 0))[home]
                margin = radius * min(0.5, deviations / np.sqrt(dim))
                border = cosines[np.arange(len(home)), home][:, None] - cosines <= margin * apart + SLACK
                border[np.arange(len(home)), home] = True
                row, cell = np.nonzero(border)
                lists = [np.flatnonzero(x).astype(np.int32) for x in border]
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column(0).take(pa.array(row)),
                        own.column(1).take(pa.array(row)),
                        pa.array(cell, pa.int32()),
                        pa.array(home[row], pa.int32()),
                        pa.array([lists[i] for i in row], pa.list_(pa.int32())),
                        *(own.column(i).take(pa.array(row)) for i in (2, 3, 4)),
                    ],
                    names=["label", "dim", "cell", "home", "cells", "node", "n", "vector"],
                )

    return classes.select("label", "dim", "node", "n", "vector").mapInArrow(assign, schema)


def _blocks(assigned: DataFrame, block_rows: int) -> DataFrame:
    """Rows dealt to block products: a home block on the left, home or border block right.

    Homes come before border rows in the numbering of blocks; products of two home blocks are
    made once. A cell has as many blocks as its size asks for.
    """
    own = ["label", "dim", "cell"]
    is_home = F.col("cell") == F.col("home")
    sizes = assigned.groupBy(*own).agg(
        F.ceil(F.count(F.when(is_home, 1)) / block_rows).cast("int").alias("homes"),
        F.ceil(F.count(F.when(~is_home, 1)) / block_rows).cast("int").alias("borders"),
    ).where(F.col("homes") > 0)
    draw = F.xxhash64("node")
    block = F.when(is_home, F.pmod(draw, F.col("homes"))).otherwise(
        F.col("homes") + F.pmod(draw, F.greatest("borders", F.lit(1)))
    ).cast("int")
    dealt = assigned.join(sizes, own).withColumn("block", block)
    last = F.col("homes") + F.col("borders") - 1
    as_left = F.when(
        is_home, F.transform(
            F.sequence(F.col("block"), last),
            lambda j: F.struct(F.col("block").alias("i"), j.alias("j"), F.lit(True).alias("left")),
        )
    ).otherwise(F.array().cast("array<struct<i: int, j: int, left: boolean>>"))
    most = F.least("block", F.col("homes") - 1)
    as_right = F.filter(
        F.transform(
            F.sequence(F.lit(0), most),
            lambda i: F.struct(i.alias("i"), F.col("block").alias("j"), F.lit(False).alias("left")),
        ),
        lambda x: x["i"] != x["j"],
    )
    return dealt.withColumn("task", F.explode(F.concat(as_left, as_right))).select(
        *own, "task.i", "task.j", "task.left", "home", "cells", "node", "n", "vector"
    )


def _reached(
    links: np.ndarray, left: np.ndarray, right: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The smallest node that links reach, for rows and columns of a block product."""
    row, column = np.nonzero(links)
    label_left, label_right = left.copy(), right.copy()
    order = np.argsort(column, kind="stable")
    rows, row_at = np.unique(row, return_index=True)
    columns, column_at = np.unique(column[order], return_index=True)
    while len(rows):
        before = label_left.copy(), label_right.copy()
        label_left[rows] = np.minimum(
            label_left[rows], np.minimum.reduceat(label_right[column], row_at)
        )
        label_right[columns] = np.minimum(
            label_right[columns], np.minimum.reduceat(label_left[row[order]], column_at)
        )
        if (before[0] == label_left).all() and (before[1] == label_right).all():
            break
    return label_left, label_right


def _product(cosine: float):
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("reached", pa.int64())])

    def product(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        is_left = table.column("left").to_numpy()
        dim, cell = table.column("dim")[0].as_py(), table.column("cell")[0].as_py()
        same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        left = table.filter(pa.array(is_left))
        right = left if same else table.filter(pa.array(~is_left))
        if not len(left) or not len(right):
            return schema.empty_table()
        nodes, others = (x.column("node").to_numpy() for x in (left, right))
        links = _matrix(left.column("vector"), dim) @ _matrix(
            right.column("vector"), dim
        ).T >= cosine
        if same:
            links &= nodes[:, None] != others[None, :]
        homes = right.column("home").to_numpy()
        for home in np.unique(homes[homes < cell]).tolist():
            there = np.array([home in cells for cells in left.column("cells").to_pylist()])
            links[np.ix_(there, homes == home)] = False
        reached, reached_right = _reached(links, nodes, others)
        parts = [(nodes, links @ right.column("n").to_numpy(), reached)]
        if not same:
            parts.append((others, links.T @ left.column("n").to_numpy(), reached_right))
        node, count, low = (np.concatenate(x) for x in zip(*parts, strict=True))
        linked = count > 0
        return pa.table([node[linked], count[linked], low[linked]], schema=schema)

    return product


def embedding_dedup(
    vectors: DataFrame,
    cosine: float = COSINE,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
    deviations: float = DEVIATIONS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label).

    Vectors of equal label and length are linked at a cosine of at least ``cosine``. Null
    labels, and vectors that are null, empty, zero or hold null or non-finite components, link
    with nothing. Equal vectors of a label are compared as one and count as many. The row of
    the smallest vec_id of a component is kept. Rows that share an id, or have none, are
    vectors of their own. Other columns are not read; empty in, empty out.
    """
    ship_package(vectors.sparkSession)
    own = keyed(vectors, "vec_id", "label", "embedding")
    units = materialize(_units(own), "units")
    classes = materialize(
        units.groupBy("label", "vector").agg(
            F.min("_key").alias("node"), F.count(F.lit(1)).alias("n"), F.first("dim").alias("dim")
        ),
        "vector-classes",
    )
    assigned = materialize(
        _assigned(classes, _fit(classes, cell_rows), cosine, deviations), "cells"
    )
    schema = "node long, links long, reached long"
    found = materialize(
        _blocks(assigned, block_rows).groupBy("label", "dim", "cell", "i", "j").applyInArrow(
            _product(cosine), schema
        ), "block-links"
    )
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    links = found.select(F.col("node").alias("a"), F.col("reached").alias("b"))
    grouped = with_components(classes.join(counts, "node", "left"), "node", links).select(
        "label", "vector", "component", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    joined = units.select("_key", "label", "vector").join(grouped, ["label", "vector"]).select(
        "_key", "n_links", "component"
    )
    ids = own.select("_key", "vec_id")
    firsts = ids.select(F.col("_key").alias("component"), F.col("vec_id").alias("component_id"))
    return (
        ids.join(joined, "_key", "left")
        .withColumn("component", F.coalesce("component", "_key"))
        .join(firsts, "component")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "component_id",
            (F.col("_key") == F.col("component")).alias("kept"),
        )
    )
