"""Connected components as a loop of joins and partial aggregations (ITR5)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.plans.materialize import materialize, release


#: Edges that a task connects at once.
CHUNK = 1 << 17


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", by: tuple[str, ...] = (), near: tuple[str, ...] = ()) -> DataFrame:
    """(*by, node, component) for every node that has an edge; component is the smallest node id reachable.

    Ids need be unique only among rows of the same `by` (a scene): equal ids of two scenes are two nodes.
    Alternates two steps until the edge set stops changing: every node's larger neighbours are
    hooked to its smallest neighbour, then every node's smaller neighbours are. Each step takes a
    minimum by node (a partial aggregation, so a hub does not meet in one task), writes it, so that
    Spark can split the join back by a hub, and joins. Each round is written to the shared folder. Null ids and self edges carry no link.

    Edges may have columns `near` that tell where they are: those of one place are dealt together, and a task connects them CHUNK at a time
    by themselves, so that the loop is over the links between such parts, and not over nodes that have no neighbours elsewhere. Places change nothing but the work.
    """
    if near:
        return _by_parts(edges, src, dst, by, near)
    key, pair = [*by, "u"], [*by, "u", "v"]
    e = edges.select(*by, F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    e = materialize(e.select(*by, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    mark = _mark(e, pair)
    while mark[0]:
        both = e.union(e.select(*by, F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy(*key).agg(F.min("v").alias("m")).select(*key, F.least("u", "m").alias("m")), "cc-low")
        large = both.where("v > u").join(low, key).select(*by, F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "cc-large")
        release(low)
        low = materialize(large.groupBy(*key).agg(F.min("v").alias("m")), "cc-low")
        hooked = large.join(low, key).select(*by, F.col("v").alias("u"), F.col("m").alias("v")).union(low.select(*key, F.col("m").alias("v")))
        small = materialize(hooked.where("u <> v").distinct(), "cc-small")
        for t in (e, large, low):
            release(t)
        e, last, mark = small, mark, _mark(small, pair)
        if mark == last:
            break
    return e.select(*by, F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(*by, F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _by_parts(edges: DataFrame, src: str, dst: str, by: tuple[str, ...], near: tuple[str, ...]) -> DataFrame:
    e = edges.select(*by, F.col(src).alias("u"), F.col(dst).alias("v"), *(F.col(c).alias(f"_{k}") for k, c in enumerate(near))).where("u <> v")
    places = [*by, *(f"_{k}" for k in range(len(near)))]
    out = e.select(*by, F.col("u").alias("node"), F.col("v").alias("root"))
    own = e.repartition(*places).sortWithinPartitions(*places).select(*by, "u", "v")
    roots = materialize(own.mapInArrow(_connected(len(by)), out.schema).distinct(), "cc-roots")
    # a node in several parts has a root in each; they are linked by the smallest
    low = materialize(roots.groupBy(*by, "node").agg(F.min("root").alias("low"), F.max("root").alias("high")), "cc-lowest")
    links = roots.join(low.where("low < high").drop("high"), [*by, "node"]).where("root <> low")
    comp = connected_components(links, "root", "low", by).withColumnRenamed("node", "low")
    return low.join(comp, [*by, "low"], "left").select(*by, "node", F.coalesce("component", "low").alias("component"))


def _connected(n_by: int):
    """(*by, node, root) of the edges (*by, u, v) of a chunk: the smallest node that a node's edges within it reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                held.append(b.slice(at, CHUNK))
                n += held[-1].num_rows
                if n >= CHUNK:
                    yield connect(held)
                    held, n = [], 0
        if n:
            yield connect(held)

    def connect(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        m = t.num_rows
        scene = np.zeros(2 * m, np.int64)
        for c in t.columns[:n_by]:
            code, distinct = pd.factorize(c.to_pandas(), use_na_sentinel=False)
            scene = scene * (len(distinct) + 1) + np.tile(code, 2)
            scene = np.unique(scene, return_inverse=True)[1]
        ends = pa.chunked_array([*t.column(n_by).chunks, *t.column(n_by + 1).chunks]).combine_chunks()
        # codes in the order of the ids
        code, distinct = pd.factorize(ends.to_pandas(), sort=True)
        key, first, at = np.unique(scene * (len(distinct) + 1) + code, return_index=True, return_inverse=True)
        u, v, low = at[:m], at[m:], np.arange(len(key))
        while True:
            was = low.copy()
            least = np.minimum(low[u], low[v])
            np.minimum.at(low, was[u], least)
            np.minimum.at(low, was[v], least)
            while (low[low] < low).any():
                low = low[low]
            if (low == was).all():
                break
        node, root = first, first[low]
        cols = [c.combine_chunks().take(pa.array(node % m)) for c in t.columns[:n_by]]
        return pa.RecordBatch.from_arrays([*cols, ends.take(pa.array(node)), ends.take(pa.array(root))], names=[*t.column_names[:n_by], "node", "root"])

    return run


def _mark(e: DataFrame, pair: list[str]) -> tuple:
    """Count and order-free digest of the edges, to tell when a round changed nothing."""
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64(*pair).cast("decimal(20,0)"))).first())
