"""Connected components of a link table: links that are together in a task are contracted there, the rest meets by alternating large and small stars."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sonorum.llm.common import materialize, only_the_last_stays


#: A node with so many links, and one in a thousand of all, is hot; its least neighbour is copied to so many join keys.
HOT, COPIES = 100_000, 64


def _stars(links: DataFrame, n_links: int, hot_from: int) -> DataFrame:
    """Large star: every greater neighbour of a node links to the least of its neighbourhood."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("c")).withColumn("m", F.least("u", "m"))
    keys = ["u"]
    if n_links >= hot_from:  # else no node can be hot
        is_hot = F.col("c") >= max(hot_from, n_links / 1000)
        hot = F.broadcast(least.filter(is_hot).select("u", F.lit(True).alias("hot")))  # 2,000 nodes at most, as links have two ends
        both = both.join(hot, "u", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("v"), F.lit(COPIES)).cast("int")).otherwise(0))
        least = least.withColumn("salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(COPIES - 1))).otherwise(F.array(F.lit(0)))))
        keys = ["u", "salt"]
    return both.join(least.drop("c"), keys).filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_stars(links: DataFrame) -> DataFrame:
    """Small star: the lesser neighbours of a node, and the node, link to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


#: So many links are contracted at once.
AT_ONCE = 1_000_000


def least_labels(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least position of each position's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        label = label[label]
        if (label == before).all():
            return label


def _contracted(links: DataFrame, at_once: int) -> DataFrame:
    """a, b, part: the links of a task, `at_once` at a time (a part), as links of each node to the least one that they join it with."""
    kind = links.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, n = [], 0
        for batch in batches:
            for k in range(0, batch.num_rows, at_once):
                piece = batch.slice(k, at_once)
                if got and n + piece.num_rows > at_once:
                    yield stars(got)
                    got, n = [], 0
                got.append(piece)
                n += piece.num_rows
        if n:
            yield stars(got)

    def stars(got: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = pa.concat_arrays([b.column(c) for c in (0, 1) for b in got]).dictionary_encode()
        order = pc.sort_indices(ends.dictionary).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        one, other = place[ends.indices.to_numpy()].reshape(2, -1)
        label = least_labels(len(order), one, other)
        moved = np.flatnonzero(label != np.arange(len(order)))
        nodes = ends.dictionary.take(pa.array(order))
        part = pa.array([uuid.uuid4().hex] * len(moved), pa.string())
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(moved)), nodes.take(pa.array(label[moved])), part], ["a", "b", "part"])

    return links.mapInArrow(run, f"a {kind}, b {kind}, part string")


def connected_components(links: DataFrame, hot_from: int = HOT, at_once: int = AT_ONCE) -> DataFrame:
    """node -> root, the least node of its component, for all nodes with a link other than the root.

    links: a, b of one orderable type; order, repeats, loops and nulls do not matter. Minima are
    aggregated before they meet the links again, and a node of at least `hot_from` links meets them in many parts.
    What one task contracted whole, `at_once` links at most, is the result; so a table that is down to so many goes to one task, without more stars.
    """
    links = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = None
    with only_the_last_stays(links.sparkSession):
        while True:
            seen = Observation()
            told = (F.count("a").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"), F.min("part").alias("low"), F.max("part").alias("high"))
            links = materialize(_contracted(links, at_once).observe(seen, *told).drop("part"), "links")
            found = seen.get
            now = (found["n"], found["sum"])
            if found["low"] == found["high"] or now == state:  # without links both are null
                break
            if found["n"] <= at_once:
                links = links.coalesce(1)
                continue
            state = now
            links = _small_stars(_stars(links, found["n"], hot_from))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
