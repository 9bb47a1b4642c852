"""Jaccard join of n-gram sets by parity sketches.

Every hash of a set flips one bit of its sketch, so two sketches differ in no more bits than the sets differ in
hashes. Sizes are cut into bands, each so wide that two sets of the similarity are in one band or in neighbours. For sets
of a band and the next the similarity leaves at most k different hashes; their sketches have k + 1 + spare words, of
which two similar sets share at least 1 + spare. The words of a band, by place, are the keys of the join. Words of few
bits are often equal by chance, so a set that has at most `spare` of them leaves them out: a shared word is left out by both sets or by
none, and one more is left. Sets that share no key with another have no partner. The others meet by keys: in two rounds each with its likeliest partner of another group, and last
with all of other groups, where whole-set sketches of a fixed size rule pairs out and the sets themselves decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonorum.llm.common import count_partitions, in_parts, materialize, read_table
from sonorum.llm.components import connected_components
from sonorum.llm.simhash import _folded, _lists, bitmaps, joined_roots, likely_pairs, remaining_pairs, shingle_set
from sonorum.operators.joins import join_one_per_key


def bands(percent: int, up_to: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """(least size of each band, most different hashes of two similar sets of which the lesser is in the band), for sizes up to `up_to`."""
    starts, apart = [1], []
    while starts[-1] <= up_to:
        starts.append(max(starts[-1] + 1, starts[-1] * 100 // percent + 1))
        least = starts[-1] - 1
        together = least + least * 100 // percent
        apart.append((100 - percent) * together // (100 + percent))
    return np.array(starts), np.array(apart)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x ^ x >> np.uint64(31)


#: One in so many keys is asked for a likely partner in a round before the last. It decides about time and no result.
ASKED = 4
#: Bits of a word, so many that two hashes of a set hardly ever share one.
WIDTH = 1024
#: Share of words that a sketch has beyond k + 1, and the bits up to which a word is poor.
SPARE, POOR = 0.25, 1


def sketch(hashes: np.ndarray, words: int) -> np.ndarray:
    """The set bits of a sketch of `words` words of WIDTH bits, in order: those that an odd number of hashes flip."""
    bits, times = np.unique((hashes >> np.uint64(17)) % np.uint64(WIDTH * words), return_counts=True)
    return bits[times % 2 == 1]


def band_keys(hashes: np.ndarray, band: int, apart: int, turn: int = 0) -> np.ndarray:
    """A key of each word of the set's sketch for a band, other words in each turn; none where similar sets are equal."""
    if not apart:
        return np.zeros(0, np.int64)
    spare = 1 + int(SPARE * apart)
    words = np.zeros(apart + 1 + spare, np.uint64)
    bits = sketch(_mixed(hashes + np.uint64(turn)) if turn else hashes, len(words))
    at = (bits // np.uint64(WIDTH)).astype(np.int64)
    np.bitwise_xor.at(words, at, _mixed(bits + np.uint64(1)))  # equal words, equal numbers
    rich = np.bincount(at, minlength=len(words)) > POOR
    if np.count_nonzero(~rich) > spare:
        rich[:] = True
    places = _mixed(np.arange(len(words), dtype=np.uint64) + np.uint64(band << 32))
    return _mixed(words[rich] + places[rich]).view(np.int64)


def set_keys(hashes: np.ndarray, edges: tuple[np.ndarray, np.ndarray], turn: int = 0) -> np.ndarray:
    """The keys of a set in its own band, as the lesser or an equal, and in the one below, as the greater."""
    starts, apart = edges
    at = int(np.searchsorted(starts, len(hashes), "right")) - 1
    return np.concatenate([np.zeros(0, np.int64), *(band_keys(hashes.view(np.uint64), b, int(apart[b]), turn) for b in (at - 1, at) if b >= 0)])


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, rid, text: rid is of the id, or of the text where that is null, so that many rows without id are no hot key."""
    rid = F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).otherwise(F.xxhash64(id_col))
    return docs.select(F.col(id_col).alias("doc_id"), rid.alias("rid"), F.col(text_col).cast("binary").alias("text"))


def _digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def sketched(docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, rid, digest (of the set), n, keys: one row for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = bands(percent)
        for batch in in_parts(batches):
            rows, keys = [], []
            for text in batch.column(2):
                own = shingle_set(_folded(text.as_py()), words)
                keys.append(set_keys(own, edges))
                rows.append((_digest(own), len(own)))
            columns = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), _lists(keys)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "rid", "digest", "n", "keys"])

    ids = docs.schema[id_col].dataType.simpleString()
    return _numbered(docs, id_col, text_col).mapInArrow(run, f"doc_id {ids}, rid bigint, digest binary, n bigint, keys array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """node, hashes: the sets of `wanted` (node, rid, digest), each read from one of its texts again and dealt by node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            found = [shingle_set(_folded(text.as_py()), words) for text in batch.column(2)]
            own = [k for k, (hashes, digest) in enumerate(zip(found, batch.column(1), strict=True)) if _digest(hashes) == digest.as_py()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own, pa.int64())), _lists([found[k] for k in own])], ["node", "hashes"])

    texts = _numbered(docs, id_col, text_col).join(wanted, "rid").select("node", "digest", "text")
    read = texts.mapInArrow(run, "node bigint, hashes array<bigint>")
    return read.repartition(max(count_partitions(docs.sparkSession), 1), "node").groupBy("node").agg(F.first("hashes").alias("hashes"))


def _short() -> Column:
    return F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("bigint")


def shared_tokens(tokens: DataFrame, node: str = "node") -> DataFrame:
    """The rows of tokens (node, token) of which several nodes have the token. Rows are dealt by token once, and stay so."""
    own = Window.partitionBy("token")
    both = tokens.withColumn("low", F.min(node).over(own)).withColumn("high", F.max(node).over(own))
    return both.filter("low < high").select(node, "token")


def recut(rooted: DataFrame, sets: DataFrame, percent: int, most: int) -> DataFrame:
    """rooted, but that the tokens of more than `most` nodes, of several roots, are cut again by other sketches of the same nodes.

    Similar sets that share a token share a word of their other sketches too.
    """
    counts = rooted.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    counts = materialize(counts.select("token", "c"), "counts")
    light, heavy = counts.filter(F.col("c") <= most).select("token"), counts.filter(F.col("c") > most).select("token")
    kept = rooted.join(light, "token")
    if heavy.isEmpty():
        return kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = bands(percent)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("node"), _lists([set_keys(own, edges, 1) for own in (np.asarray(h.values) for h in batch.column("hashes"))])], ["node", "keys"])

    hot = materialize(rooted.join(heavy, "token").select("node", "token"), "hot")
    own = sets.join(hot.select("node").distinct(), "node", "left_semi").select("node", "hashes").mapInArrow(run, "node bigint, keys array<bigint>")
    finer = hot.join(own, "node").select("node", "token", F.explode("keys").alias("key")).select("node", F.xxhash64("token", "key").alias("token"))
    return kept.unionByName(shared_tokens(finer.distinct()).join(rooted.select("node", "root").distinct(), "node"))


def similar_sets(
    docs: DataFrame, words: int = 4, percent: int = 85, rounds: int = 2, most: int = 2_000, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable by links), one row for each row of docs.

    Two texts are linked where 100 times the size of their sets' intersection is at least `percent` times that of their union. Texts with
    one set are one node, however many there are. Every link counts, but of a group that is joined already no
    more pairs are compared; `rounds` and `most` decide about time and no result. Null, empty and blank texts have no set and are linked with nothing;
    texts of fewer than `words` words are one shingle. A null doc_id has its component but never names one. Repeated rows
    stay repeated, texts may have any length, an empty table stays empty, and extra columns of docs are not read.
    """
    sketches = materialize(sketched(docs, words, percent, id_col, text_col), "sketches")
    marked = sketches.drop("keys")
    nodes = marked.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.min("rid").alias("rid"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()).withColumn("short", _short()), "nodes")
    # texts find each other by the head of their set's digest; the keys are dealt once, and those that two sets have go on
    held = sketches.select(_short().alias("short"), F.explode("keys").alias("token"))
    found = materialize(shared_tokens(held, "short").distinct().join(nodes.select("short", "node"), "short").select("node", "token"), "shared")
    living = nodes.join(found.select("node").distinct(), "node", "left_semi").select("node", "rid", "digest")
    # the rounds below join the sets by node again and again, so they are dealt by it once
    sets = _sets(docs, living, words, id_col, text_col).persist(StorageLevel.DISK_ONLY)
    marks = materialize(sets.select("node", F.size("hashes").alias("n"), F.lit(0).alias("lone")).join(bitmaps(sets), "node"), "marks")

    def confirmed(pairs: DataFrame) -> DataFrame:
        common = F.size(F.array_intersect("sx", "sy")).cast("bigint")
        x, y = sets.select(F.col("node").alias("x"), F.col("hashes").alias("sx")), sets.select(F.col("node").alias("y"), F.col("hashes").alias("sy"))
        alike = 100 * common >= percent * (F.size("sx") + F.size("sy") - common)
        return pairs.join(x, "x").join(y, "y").filter(alike).select(F.col("x").alias("a"), F.col("y").alias("b"))

    roots = docs.sparkSession.createDataFrame([], "node bigint, root bigint")
    for turn in range(rounds + 1):
        rooted = found.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        last = turn == rounds
        pairs = remaining_pairs(recut(rooted, sets, percent, most), marks, percent / 100) if last else likely_pairs(rooted, marks, percent / 100, turn, ASKED)
        near = materialize(confirmed(materialize(pairs, "pairs")), "near")
        if not near.isEmpty():
            roots = materialize(joined_roots(roots, near) if turn else connected_components(near), "roots")

    sets.unpersist()
    placed = nodes.join(roots, "node", "left").select("digest", "first_id", F.coalesce("root", "node").alias("root"))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = placed.join(least, "root").select("digest", "component_id")
    linked = join_one_per_key(marked.filter("n > 0"), named, "digest").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(marked.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(read_table(spark, sf_dir, "documents"))
