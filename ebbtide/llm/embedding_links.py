"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosines, connected components.

Equal vectors are one class with a multiplicity, so a vector that a third of the rows share is compared once. In each
table a class falls into the bucket of its signs; the classes of a bucket are compared in blocks of bounded size, all
pairs, in double precision. A pair that has met in an earlier table does not count again, which its own codes tell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import components

COSINE = 0.9
#: Classes that a bucket should hold on average, and the chance with which a pair at the threshold is found.
BUCKET, RECALL = 64, 0.995
MOST_BITS = 30
#: Classes of a bucket that are compared at a time.
BLOCK = 1024
SEED = 20


def tables_for(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables): more vectors take more bits, and so many tables that the recall stays the same."""
    bits = min(MOST_BITS, max(6, math.ceil(math.log2(max(n, 1) / BUCKET)) if n > BUCKET else 6))
    met = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - met))


def hyperplanes(dimensions: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimensions]).standard_normal((dimensions, tables * bits))


def codes(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The bucket of each row of ``x`` in each table."""
    signs = x @ hyperplanes(x.shape[1], bits, tables) > 0
    return signs.reshape(len(x), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), dimensions)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _dealt(bits: int, tables: int):
    """In tasks: each class once for each table, (table, code, dimensions, cls, copies, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                sizes = batch.column("dimensions").to_numpy()
                for d in np.unique(sizes):
                    own = batch.filter(pa.array(sizes == d))
                    found = codes(_matrix(own.column("vector"), int(d)), bits, tables)
                    for t in range(tables):
                        columns = [own.column(k) for k in ("dimensions", "cls", "copies", "vector")]
                        head = [pa.array(np.full(len(found), t, np.int32)), pa.array(found[:, t])]
                        yield pa.RecordBatch.from_arrays([*head, *columns], ["tab", "code", "dimensions", "cls", "copies", "vector"])

    return run


def _labels(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the smallest row that it can reach."""
    label = np.arange(len(linked))
    rows, columns = np.nonzero(linked)
    while len(rows):
        new = label.copy()
        np.minimum.at(new, rows, label[columns])
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _compared(bits: int, tables: int, cosine: float):
    """In tasks, blocks in order: (cls, other, n): links to count for a class, and a class that it is connected with."""

    def block(rows: pa.RecordBatch) -> pa.RecordBatch:
        cls, copies, side = (rows.column(k).to_numpy() for k in ("cls", "copies", "side"))
        table, d = rows.column("tab")[0].as_py(), rows.column("dimensions")[0].as_py()
        x = _matrix(rows.column("vector"), d)
        linked = x @ x.T >= cosine
        np.fill_diagonal(linked, False)
        linked &= (side[:, None] == 0) | (side[:, None] != side[None, :])  # rows of one block, or of two different ones
        label = _labels(linked)
        if table:
            earlier = codes(x, bits, tables)[:, :table]
            rows_, columns = np.nonzero(linked)
            for begin in range(0, len(rows_), 1 << 20):
                a, b = rows_[begin : begin + (1 << 20)], columns[begin : begin + (1 << 20)]
                met = np.zeros(len(a), bool)
                for t in range(table):
                    met |= earlier[a, t] == earlier[b, t]
                linked[a[met], b[met]] = False
        n = linked @ copies.astype(np.int64)
        tell = (n > 0) | (label != np.arange(len(cls)))
        return pa.RecordBatch.from_arrays([pa.array(cls[tell]), pa.array(cls[label][tell]), pa.array(n[tell])], ["cls", "other", "n"])

    def blocks(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        key = np.stack([rows.column(k).to_numpy().astype(np.int64) for k in ("tab", "code", "dimensions", "i", "j")])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1), rows.num_rows]
        for begin, end in zip(cuts[:-1], cuts[1:]):
            yield rows.slice(begin, end - begin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []  # a block may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            *whole, last = blocks(pa.Table.from_batches([*rest, batch]).combine_chunks().to_batches()[0])
            rest = [last]
            yield from map(block, whole)
        yield from map(block, rest)

    return run


def links(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """One row for each row of ``vectors``: vec_id, n_links, component_id, kept.

    ``vectors`` needs vec_id and embedding (an array of numbers); other columns play no part. A vector that is null,
    empty or zero, or holds null or non-finite numbers, links with nothing; vectors of different lengths do not link.
    A repeated row is a vector of its own that is equal to the other. ``n_links`` counts the other vectors whose cosine
    was found to be at least ``cosine``; ``component_id`` is the smallest vec_id that links lead to. A row without
    vec_id is counted by the others, and has a component only if one of them has an id. An empty table gives an empty
    one. A pair at the threshold is found with chance ``recall`` at least, a closer one with a larger one.
    """
    own = vectors.select("vec_id", F.col("embedding").alias("vector"))
    # adding 0.0 turns -0.0 into 0.0, so that equal vectors are equal bit by bit
    own = own.withColumn("vector", F.transform("vector", lambda v: v + F.lit(0.0).cast(_element(vectors))))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.coalesce(finite & F.exists("vector", lambda v: v != 0), F.lit(False))
    own = own.withColumn("cls", F.when(usable, F.xxhash64("vector")))
    groups = own.filter("cls is not null").groupBy("cls", "vector").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first")
    )
    groups = materialize(groups.withColumn("dimensions", F.size("vector")), "groups")
    bits, tables = tables_for(groups.count(), cosine, recall)
    kind = vectors.schema["embedding"].dataType.simpleString()
    bucket = ["tab", "code", "dimensions"]
    schema = f"tab int, code long, dimensions int, cls long, copies long, vector {kind}"
    dealt = groups.select("dimensions", "cls", "copies", "vector").mapInArrow(_dealt(bits, tables), schema)
    # buckets with more than a block: few, and read again as a small table
    large = dealt.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > BLOCK)
    large = materialize(large.select(*bucket, F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks")), "large")
    own_block = F.pmod(F.xxhash64("cls"), F.col("_blocks")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda j: F.struct(
            F.least(F.col("_own"), j).alias("i"),
            F.greatest(F.col("_own"), j).alias("j"),
            F.when(F.col("_own") == j, 0).when(F.col("_own") < j, 1).otherwise(2).alias("side"),
        ),
    )
    blocks = (
        dealt.join(large, bucket, "left")
        .withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
        .withColumn("_own", own_block)
        .withColumn("_meets", F.explode(meets))
        .select(*bucket, "cls", "copies", "vector", "_meets.*")
    )
    key = [*bucket, "i", "j"]
    found = blocks.repartition(*key).sortWithinPartitions(*key)
    found = found.mapInArrow(_compared(bits, tables, cosine), "cls long, other long, n long")
    found = materialize(found.groupBy("cls", "other").agg(F.sum("n").alias("n")), "found")
    of_class = components(found.select(F.col("cls").alias("a"), F.col("other").alias("b"))).withColumnRenamed("id", "cls")
    counted = found.groupBy("cls").agg(F.sum("n").alias("n"))
    named = (
        groups.select("cls", "copies", "first")
        .join(counted, "cls", "left")
        .join(of_class, "cls", "left")
        .withColumn("component", F.coalesce("component", "cls"))
        .withColumn("n_links", F.col("copies") - 1 + F.coalesce("n", F.lit(0)))
    )
    smallest = named.groupBy("component").agg(F.min("first").alias("smallest"))
    named = named.join(smallest, "component").select("cls", "n_links", "smallest")
    return (
        own.select("vec_id", "cls")
        .join(named, "cls", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("smallest", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def _element(vectors: DataFrame) -> str:
    return vectors.schema["embedding"].dataType.elementType.simpleString()
