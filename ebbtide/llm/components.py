"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: So many edges, or fewer, are followed to their ends in one go.
FEW = 1 << 18


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every id on the task's edges but the smallest of its component: (id, that smallest)."""
    parts = [np.zeros((2, 0), np.int64), *(np.stack([b.column(k).to_numpy() for k in (0, 1)]) for b in batches)]
    names, place = np.unique(np.concatenate(parts, axis=1), return_inverse=True)
    u, v = place.reshape(2, -1)
    least = np.arange(len(names))
    while True:  # the smaller root becomes the larger one's parent, then all paths are shortened to their ends
        x, y = least[u], least[v]
        if (x == y).all():
            break
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while (least[least] != least).any():
            least = least[least]
    far = np.flatnonzero(least != np.arange(len(names)))
    yield pa.RecordBatch.from_arrays([pa.array(names[far]), pa.array(names[least[far]])], ["u", "v"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id on an edge: the smallest id that it can reach.

    Alternates two steps until nothing changes. Each hands the neighbours of a node to the smallest of them: first the
    larger neighbours, then the smaller ones. Paths halve in length with each round, and edges never grow in number.
    The minimum of a node is combined map-side; the join back is on the node, and a hub's rows are split as a skewed
    join. Every round is written to the shared folder, which cuts the lineage. FEW edges, a bound whatever the input, need
    no rounds, whose jobs would cost more than they do.
    """
    now = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).filter("u <> v").distinct()
    now, before = materialize(now, "edges"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        if state[0] <= FEW:
            now = materialize(now.coalesce(1).mapInArrow(_ends, "u long, v long"), "edges")
            break
        before = state
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "w")
        large = both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        joined = large.join(least, F.col("u") == F.col("w"))
        ends = F.explode(F.array(F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m"))))
        small = joined.select(ends.alias("e")).select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
        now = materialize(small.filter("u <> v").distinct(), "edges")
    roots = now.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
