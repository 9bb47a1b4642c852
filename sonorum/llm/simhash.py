"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are 64-bit SimHashes of word shingles. Distinct fingerprints are linked where they
differ in at most `budget` bits. The bits are cut into budget + `whole` parts; two linked fingerprints
agree on at least `whole` of them, so each fingerprint stands in one trie for each choice of `whole`
parts, which are its top levels. A trie below one value of its top is joined with itself in one task:
node pairs go down together, differing bits add up, and a pair beyond the budget is pruned. A top
value that more than `max_group` fingerprints share is cut again in the same way over its remaining
bits, so no task meets an unbounded group and no link is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonorum.llm.common import count_partitions, in_parts, materialize, read_table
from sonorum.llm.components import connected_components, least_labels
from sonorum.operators.joins import join_one_per_key

SEED = 42


def _folded(text: str | bytes | None) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return data.lower().split()


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else b""


def fingerprint(found: list[bytes], words: int) -> tuple[int, int]:
    """The fingerprint of a text's words as a signed 64-bit integer, and the number of shingles."""
    if not found:
        return 0, 0
    shingles = map(b" ".join, zip(*(found[k:] for k in range(words)), strict=False)) if len(found) >= words else [b" ".join(found)]
    n = max(1, len(found) - words + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 8192):
        part = hashes[k : k + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view(np.int64)[0]), n


def word_digest(text: Column) -> Column:
    """The digest that signatures() gives.

    Spark must not copy it into filters that it derives from a join by the digest: each copy makes the digests again, in a second Python
    worker of every task, and the workers stay. Nothing is pushed below a column that Spark is told is not deterministic.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_digest(_folded(t.as_py())) for t in batch], pa.binary())

    return F.arrow_udf(run, "binary").asNondeterministic()(text.cast("binary"))


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp bigint, shingles int, one row for each row of docs.

    Null, empty and blank texts have fingerprint 0. Whole texts count, however long; bytes that are no
    UTF-8 are bytes of a word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(_folded(t.as_py()), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f for f, _ in fps], pa.int64()), pa.array([n for _, n in fps], pa.int32())], ["doc_id", "fp", "shingles"])

    ids = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, f"doc_id {ids}, fp bigint, shingles int")


def _finer(fixed: list[list[int]], budget: int, whole: int) -> list[list[int]]:
    """Bits that each trie of the next level fixes: child k of trie t has index t * (number of choices) + k."""
    found = []
    for own in fixed:
        parts = np.array_split([b for b in range(63, -1, -1) if b not in own], budget + whole)
        found += [[*own, *map(int, np.concatenate(choice))] for choice in combinations(parts, whole)]
    return found


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def trie_links(fps: np.ndarray, groups: np.ndarray, bits: list[int], budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups as two arrays of positions. fps: uint64, distinct within a group; bits: trie order."""
    key = np.zeros(len(fps), np.uint64)
    for b in bits:
        key = key << np.uint64(1) | fps >> np.uint64(b) & np.uint64(1)
    order = np.lexsort((key, groups))
    key, sorted_fps, sorted_groups = key[order], fps[order], groups[order]
    starts = np.flatnonzero(np.r_[True, sorted_groups[1:] != sorted_groups[:-1]])
    a0 = starts
    a1 = np.r_[starts[1:], len(fps)]
    b0, b1, diff = a0, a1, np.zeros(len(a0), np.int64)
    left, right = [], []
    for depth in range(len(bits)):
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        done = single & (a0 != b0)
        if done.any():
            x, y = a0[done], b0[done]
            near = np.bitwise_count(sorted_fps[x] ^ sorted_fps[y]) <= budget
            left.append(x[near])
            right.append(y[near])
        live = ~single
        a0, a1, b0, b1, diff = a0[live], a1[live], b0[live], b1[live], diff[live]
        if not len(a0):
            break
        bit = (key >> np.uint64(len(bits) - 1 - depth) & np.uint64(1)).astype(np.int64)
        ones = np.r_[0, np.cumsum(bit)]
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        cross = a0 != b0
        children = [(a0, am, b0, bm, diff), (am, a1, bm, b1, diff), (a0, am, bm, b1, diff + 1), (am[cross], a1[cross], b0[cross], bm[cross], diff[cross] + 1)]
        a0, a1, b0, b1, diff = (np.concatenate(x) for x in zip(*children, strict=True))
        kept = (a0 < a1) & (b0 < b1) & (diff <= budget)
        a0, a1, b0, b1, diff = a0[kept], a1[kept], b0[kept], b1[kept], diff[kept]
    last = (a0 != b0) & (a1 - a0 == 1) & (b1 - b0 == 1) if len(a0) else np.zeros(0, bool)
    left.append(a0[last])
    right.append(b0[last])
    return order[np.concatenate(left)], order[np.concatenate(right)]


def spanning_forest(n: int, x: np.ndarray, y: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links, fewer than n, that connect what all links connect, the closest first: every component takes its closest link out, until none leads out."""
    order = np.argsort(distance, kind="stable")
    x, y = x[order], y[order]
    label, taken = np.arange(n), []
    while True:
        out = label[x] != label[y]
        x, y = x[out], y[out]
        if not len(x):
            break
        best = np.full(n, len(x))
        np.minimum.at(best, label[x], np.arange(len(x)))
        np.minimum.at(best, label[y], np.arange(len(x)))
        pick = np.unique(best[best < len(x)])
        taken.append((x[pick], y[pick]))
        label = least_labels(n, label[x[pick]], label[y[pick]])[label]
    if not taken:
        return x, y
    return tuple(np.concatenate(side) for side in zip(*taken, strict=True))


def near_links(distinct: DataFrame, budget: int = 2, whole: int = 1, max_group: int = 4096) -> DataFrame:
    """a, b: links among distinct fingerprints (column fp) that connect all that differ in at most `budget` bits.

    Of the links inside one trie only a spanning forest of the closest is returned, so rows stay
    below the number of tries times the fingerprints, and components are those of all links. Only the
    values of tops that are cut again are listed apart from the fingerprints.
    """
    choices = math.comb(budget + whole, whole)
    rest = distinct.select(F.lit(0).alias("trie"), F.col("fp"))
    masks, found = [[]], None
    while True:
        masks = _finer(masks, budget, whole)
        children = F.array(*[F.col("trie") * choices + k for k in range(choices)])
        tries = F.array(*[F.lit(_mask(bits)).cast("bigint") for bits in masks])
        at = rest.select("fp", F.explode(children).alias("trie"))
        at = at.withColumn("top", F.col("fp").bitwiseAND(F.get(tries, F.col("trie"))))
        if 64 - len(masks[0]) <= 12:  # a group has 4,096 fingerprints at most
            return _joined_tries(at, masks, budget) if found is None else found.unionByName(_joined_tries(at, masks, budget))
        heavy = materialize(at.groupBy("trie", "top").count().filter(F.col("count") > max_group).select("trie", "top"), "heavy")
        none = heavy.isEmpty()
        links = _joined_tries(at if none else at.join(heavy, ["trie", "top"], "left_anti"), masks, budget)
        found = links if found is None else found.unionByName(links)
        if none:
            return found
        rest = materialize(at.join(heavy, ["trie", "top"], "left_semi").select("trie", "fp"), "tries")


def _joined_tries(rows: DataFrame, masks: list[list[int]], budget: int) -> DataFrame:
    """rows: trie, top, fp; every (trie, top) is joined with itself inside one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        trie = table.column("trie").to_numpy()
        top = table.column("top").to_numpy()
        fps = table.column("fp").to_numpy().view(np.uint64)
        order = np.lexsort((top, trie))
        alike = (trie[order][1:] == trie[order][:-1]) & (top[order][1:] == top[order][:-1])
        own = order[np.r_[False, alike] | np.r_[alike, False]]  # a fingerprint alone under its top has no partner there
        trie, top, fps = trie[own], top[own], fps[own]
        for t in np.unique(trie):
            own = np.flatnonzero(trie == t)
            order = own[np.argsort(top[own], kind="stable")]
            group = np.cumsum(np.r_[0, top[order][1:] != top[order][:-1]])
            bits = [b for b in range(63, -1, -1) if b not in set(masks[t])]
            ends = np.flatnonzero(np.r_[group[1:] != group[:-1], True]) + 1
            start = 0
            while start < len(order):  # whole groups, some 100,000 fingerprints at a time
                end = int(ends[min(np.searchsorted(ends, start + 100_000), len(ends) - 1)])
                part = order[start:end]
                own_fps = fps[part]
                x, y = trie_links(own_fps, group[start:end], bits, budget)
                x, y = spanning_forest(len(part), x, y, np.bitwise_count(own_fps[x] ^ own_fps[y]))
                if len(x):
                    signed = own_fps.view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(signed[x]), pa.array(signed[y])], ["a", "b"])
                start = end

    n = max(count_partitions(rows.sparkSession), 1)
    return rows.select("trie", "top", "fp").repartition(n, "trie", "top").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    words: int = 3,
    budget: int = 2,
    whole: int = 1,
    min_shingles: int = 0,
    max_group: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, fp, component_id (the least doc_id reachable by links), one row for each row of docs.

    Equal fingerprints are one node however many documents carry them. Fingerprints that only
    documents with fewer than `min_shingles` shingles carry link to equal ones alone. Documents
    without words have fingerprint 0 and link like any other. A null doc_id is reported with its
    component but never names one; repeated rows stay repeated; extra columns of docs are not read.
    """
    marked = materialize(fingerprints(docs, words, id_col, text_col), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.max("shingles").alias("shingles"))
    roots = connected_components(near_links(nodes.filter(F.col("shingles") >= min_shingles).select("fp"), budget, whole, max_group)).withColumnRenamed("node", "fp")
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    names = placed.select("fp", "root").join(least, "root").select("fp", "component_id")
    return join_one_per_key(marked, names, "fp").select("doc_id", "fp", "component_id")


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of `size` words; fewer words are one shingle, none have none."""
    if not words:
        return np.zeros(0, np.int64)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, max(1, len(words) - size + 1)).view(np.int64))


def at_least(similarity: float, n: int) -> int:
    """The least whole number that is `similarity` of n."""
    return math.ceil(similarity * n - 1e-9)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


#: Share of a set by which its prefix is longer than one shared shingle asks for.
EXTRA = 0.1


def signatures(docs: DataFrame, words: int, finger_words: int, similarity: float) -> DataFrame:
    """doc_id, fp, shingles, digest (128 bits of the words in order), n, needed, prefix: one row for each row of docs.

    prefix has so many of the least hashes of the text's set of n `words`-word shingles that a set of
    the similarity has at least `needed` of them in its own prefix: if not, the rest of one would be too few.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            rows, prefixes = [], []
            for text in batch.column(1):
                found = _folded(text.as_py())
                own = shingle_set(found, words)
                least = at_least(similarity, len(own))
                prefixes.append(own[: len(own) - least + max(1, int(EXTRA * len(own)))])
                rows.append((*fingerprint(found, finger_words), _digest(found), len(own), max(1, int(EXTRA * least))))
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, _lists(prefixes)], ["doc_id", "fp", "shingles", "digest", "n", "needed", "prefix"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {ids}, fp bigint, shingles int, digest binary, n int, needed int, prefix array<bigint>")


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, digest, hashes: the whole shingle set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            found = [_folded(text.as_py()) for text in batch.column(1)]
            columns = [batch.column(0), pa.array(map(_digest, found), pa.binary()), _lists([shingle_set(f, size) for f in found])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "hashes"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {ids}, digest binary, hashes array<bigint>")


def _least_share(similarity: float, n: Column) -> Column:
    return F.ceil(similarity * n - 1e-9).cast("int")


#: Words of 64 bits of a set's bitmap.
BITMAP = 8


def bitmaps(sets: DataFrame) -> DataFrame:
    """node, bits: for each of 64 * BITMAP slots whether an odd number of the set's hashes fall there.

    Two sets differ in at least as many hashes as their bitmaps differ in bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch.column(1).offsets.to_numpy()
            slots = (batch.column(1).values.to_numpy().view(np.uint64) >> np.uint64(17)) % np.uint64(64 * BITMAP)
            odd = [np.packbits(np.bincount(slots[a:b].astype(np.int64), minlength=64 * BITMAP).astype(np.uint8) & 1) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            flat = np.concatenate(odd).view(np.int64) if odd else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(odd) + 1) * BITMAP, pa.int32()), pa.array(flat))], ["node", "bits"])

    return sets.select("node", "hashes").mapInArrow(run, "node bigint, bits array<bigint>")


def token_sets(sets: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(node, token), (node, n, lone, bits): the tokens by which sets (node, hashes) find each other, and what is known of a node; lone are its shingles that no other set has.

    Two sets of the similarity share a token. A node's shingles are in order of how many sets hold
    them, and its tokens are the first of them, without the `lone` ones, which no pair shares. A set
    with more lone shingles than the similarity allows has no partner and no token. That is found out first among
    all sets and then again among the rest.
    """
    for _ in range(2):
        sets = sets.withColumn("n", F.size("hashes"))
        held = sets.select("node", F.explode("hashes").alias("token"))
        alone = held.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).filter("c = 1").groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("lone"))
        left = sets.join(alone, "node", "left").withColumn("lone", F.coalesce("lone", F.lit(0)))
        sets = materialize(left.filter(F.col("n") - F.col("lone") >= F.greatest(F.lit(1), _least_share(similarity, F.col("n")))).select("node", "hashes"), "sets")
    held = sets.select("node", F.size("hashes").alias("n"), F.explode("hashes").alias("token"))
    counts = held.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    ordered = held.join(counts, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("c", "token"))).alias("tokens"))
    ordered = ordered.withColumn("lone", F.col("n") - F.size("tokens"))
    wanted = F.col("n") - _least_share(similarity, F.col("n")) + 1 - F.col("lone")
    listed = materialize(ordered.filter(wanted > 0).select("node", "n", "lone", F.slice("tokens.token", F.lit(1), wanted).alias("token")), "listed")
    return listed.select("node", F.explode("token").alias("token")), listed.select("node", "n", "lone").join(bitmaps(sets), "node")


def _apart(one: str, other: str) -> Column:
    """In how many bits the bitmaps of two sets (structs with bits) differ."""
    return sum((F.bit_count(F.get(f"{one}.bits", F.lit(k)).bitwiseXOR(F.get(f"{other}.bits", F.lit(k)))) for k in range(BITMAP)), F.lit(0))


def _can_be(similarity: float, one: str, other: str) -> Column:
    """Whether two sets (structs with n, lone, bits and apart, the bits in which they differ) can have the similarity.

    They share no lone shingle, and differ in at least as many shingles as their bitmaps differ in bits.
    """
    n, m, lone, alone, apart = F.col(f"{one}.n"), F.col(f"{other}.n"), F.col(f"{one}.lone"), F.col(f"{other}.lone"), F.col("apart")
    shared = F.least(n - lone, m - alone)
    return (shared >= similarity * (shared + lone + alone) - 1e-9) & (n + m - apart >= similarity * (n + m + apart) - 1e-9) & (F.least(n, m) >= similarity * F.greatest(n, m) - 1e-9)


def likely_pairs(tokens: DataFrame, marks: DataFrame, similarity: float, turn: int, share: int = 1) -> DataFrame:
    """x, y: for every node the likeliest partner of another root, by tokens (node, root, token) and marks (node, n, lone, bits).

    A token names a node, to nodes of that root one of another, other ones by each token and in each turn. A node gets one partner, of those
    that its tokens name the one whose bitmap is nearest. Only least values of tokens are aggregated, so no token is too frequent.
    One token in `share` is asked, other ones in each turn.
    """
    asked = tokens if share == 1 else tokens.filter(F.pmod(F.xxhash64("token"), F.lit(share)) == turn % share)
    named = asked.withColumn("own", F.struct(F.xxhash64("node", "token", F.lit(turn)).alias("o"), "node", "root"))
    first = named.groupBy("token").agg(F.min("own").alias("first"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("token", "first")
    met = named.select("token", "own").join(first, "token")
    second = met.filter(F.col("own.root") != F.col("first.root")).groupBy("token").agg(F.min("own").alias("second"))
    met = met.join(second, "token").withColumn("other", F.when(F.col("own.root") != F.col("first.root"), F.col("first")).otherwise(F.col("second")))
    pairs = met.select(F.col("own.node").alias("x"), F.col("other.node").alias("y")).distinct()
    one, two = (marks.select(F.col("node").alias(c), F.struct("n", "lone", "bits").alias(name)) for c, name in (("x", "own"), ("y", "other")))
    near = pairs.join(one, "x").join(two, "y").withColumn("apart", _apart("own", "other")).filter(_can_be(similarity, "own", "other"))
    best = near.groupBy("x").agg(F.max_by("y", F.struct(-F.col("apart"), -F.col("y"))).alias("y"))
    return best.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


#: So many of a node's least tokens go with it where pairs are listed: similar sets nearly always have some of them in common.
LEAST_TOKENS = 16


def remaining_pairs(tokens: DataFrame, marks: DataFrame, similarity: float, most: int = 50_000) -> DataFrame:
    """x, y: all pairs of nodes of different roots that share a token and can have the similarity, each once."""
    return listed_pairs(tokens, marks, similarity, most, LEAST_TOKENS).distinct()


def listed_pairs(tokens: DataFrame, marks: DataFrame, similarity: float, most: int, n_least: int = 0) -> DataFrame:
    """The same, each pair once for every set of nodes that its tokens have; of tokens with the same nodes one counts.

    With `n_least` every node has so many of its least tokens with it, and a pair that has some of them in common is listed by the least of these alone.

    Within a token the nodes of the root that most of its nodes have (the major ones) meet only those of other roots. Both kinds are dealt to
    blocks of about `most` nodes. A cell is two blocks of minor nodes, or one of minor and one of major nodes, and
    lists the pairs between the two, so each pair of a token is listed in one cell, and no cell is larger than two blocks.
    """
    nodes = [F.bit_xor(F.xxhash64("node")).alias("odd"), F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(38,0)")).alias("sum")]
    sizes = tokens.groupBy("token", "root").agg(F.count(F.lit(1)).alias("count"), *nodes)
    of_token = sizes.groupBy("token").agg(
        F.max("count").alias("majors"), F.max_by("root", F.struct("count", "root")).alias("major"), F.sum("count").alias("all"), F.count(F.lit(1)).alias("roots"), F.bit_xor("odd").alias("odd"), F.sum("sum").alias("sum"),
    ).filter("roots > 1")
    of_token = of_token.groupBy("all", "odd", "sum").agg(F.min("token").alias("token"), F.min("majors").alias("majors"), F.min("major").alias("major"))
    blocks = lambda n: F.ceil(n / most).cast("int")
    met = tokens.join(of_token.select("token", "major", blocks(F.col("all") - F.col("majors")).alias("minor_blocks"), blocks(F.col("majors")).alias("major_blocks")), "token")
    if n_least:  # those of a node with fewer tokens are filled up with the first
        least = met.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("token")), 1, n_least).alias("least"))
        marks = marks.join(least.select("node", F.concat("least", F.array_repeat(F.get("least", F.lit(0)), F.lit(n_least) - F.size("least"))).alias("least")), "node")
    else:
        marks = marks.withColumn("least", F.array().cast("array<bigint>"))
    minor, width = F.col("root") != F.col("major"), F.col("minor_blocks") + F.col("major_blocks")
    own = F.pmod(F.xxhash64("node"), F.when(minor, F.col("minor_blocks")).otherwise(F.col("major_blocks"))).cast("int")
    met = met.withColumn("own", F.when(minor, own).otherwise(F.col("minor_blocks") + own)).withColumn("width", width)
    others = F.sequence(F.lit(0), F.when(minor, F.col("width")).otherwise(F.col("minor_blocks")) - 1)
    met = met.withColumn("other", F.explode(others)).withColumn("cell", F.least("own", "other").cast("bigint") * F.col("width") + F.greatest("own", "other"))
    met = met.withColumn("first", F.col("own") <= F.col("other")).withColumn("second", F.col("own") >= F.col("other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts = None, []
        for batch in batches:
            keys = list(zip(batch.column("token").to_pylist(), batch.column("cell").to_pylist(), strict=True))
            cuts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)] if keys else [0]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                if keys[begin] != group:
                    yield from meet(group, parts)
                    group, parts = keys[begin], []
                own = batch.slice(begin, end - begin)
                bits = own.column("bits").flatten().to_numpy().view(np.uint64).reshape(-1, BITMAP)
                least = own.column("least").flatten().to_numpy().reshape(own.num_rows, n_least)
                parts.append([*(own.column(c).to_numpy(zero_copy_only=False) for c in ("node", "root", "n", "lone", "first", "second")), bits, least])
        yield from meet(group, parts)

    def meet(group: tuple[int, int] | None, parts: list) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        one, two = columns[4].astype(bool), columns[5].astype(bool)  # of a cell of one block every node is on both sides
        node, root, n, lone, _, within, bits, least = (c[two] for c in columns)
        found, held = [], 0
        for i, r, m, alone, _, same, own_bits, own_least in zip(*(c[one] for c in columns), strict=True):
            shared = np.minimum(n - lone, m - alone)
            close = (shared >= similarity * (shared + lone + alone) - 1e-9) & (np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9)
            at = np.flatnonzero(close & (root != r) & ((i < node) if same else True))
            apart = np.bitwise_count(bits[at] ^ own_bits).sum(axis=1, dtype=np.int64)
            at = at[n[at] + m - apart >= similarity * (n[at] + m + apart) - 1e-9]
            if not len(at):
                continue
            common = np.isin(least[at], own_least)
            first = np.min(least[at], axis=1, where=common, initial=np.iinfo(np.int64).max)
            other = node[at[~common.any(axis=1) | (first == group[0])]]
            found.append(np.stack([np.minimum(other, i), np.maximum(other, i)]))
            held += len(other)
            if held >= 100_000:
                x, y = np.concatenate(found, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])
                found, held = [], 0
        if held:
            x, y = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])

    met = met.select("token", "cell", "node", "root", "first", "second").join(marks, "node")
    dealt = met.select("token", "cell", "node", "root", "n", "lone", "first", "second", "bits", "least").repartition(max(count_partitions(tokens.sparkSession), 1), "token", "cell").sortWithinPartitions("token", "cell")
    return dealt.mapInArrow(run, "x bigint, y bigint")


def joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """node, root after more links (a, b): only the roots that they join are put together."""
    own_a, own_b = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a")), roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    between = links.join(own_a, "a", "left").join(own_b, "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    joined = connected_components(between)
    moved = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("new")), "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    return moved.unionByName(joined)


def similar_documents(
    docs: DataFrame,
    budget: int,
    whole: int,
    similarity: float = 0.8,
    words: int = 5,
    finger_words: int = 3,
    min_shingles: int = 0,
    max_group: int = 4096,
    rounds: int = 2,
) -> DataFrame:
    """doc_id, component_id, digest, least: components of all pairs of texts whose sets of `words`-word shingles have the Jaccard similarity.

    Texts with the same words in the same order are one node. Links of near fingerprints come first:
    confirmed by the sets, they join most of what belongs together. Texts that share shingles then find what
    the fingerprints missed: in each round every node meets its likeliest partner of another group,
    and last of all every pair of different groups that can have the similarity is confirmed. So
    `budget`, `whole`, `min_shingles`, `max_group` and `rounds` decide about time and no result. Pairs within a
    group are never listed. `least` is true for the one text that stands for its component, of the
    least doc_id. Rows without doc_id have no part.
    """
    docs = docs.filter(F.col("doc_id").isNotNull())
    marked = materialize(signatures(docs, words, finger_words, similarity), "signatures")
    # the documents of one text are one node, so a text of very many copies is one node too
    once = [F.min(c).alias(c) for c in ("fp", "shingles", "n", "needed")]
    exact = marked.groupBy("digest").agg(F.min("doc_id").alias("first_id"), *once, F.min(F.size("prefix")).alias("held"))
    exact = materialize(exact.withColumn("node", F.monotonically_increasing_id()), "texts")

    # texts that share enough shingles of their prefixes with other texts; the rest have no partner
    short = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("bigint")
    holders = marked.select(short.alias("short"), F.explode("prefix").alias("token")).groupBy("token").agg(F.min("short").alias("short"), F.max("short").alias("high"))
    lone = holders.filter("short = high").groupBy("short").agg(F.count(F.lit(1)).alias("lone"))
    living = exact.filter("n > 0").withColumn("short", short).join(lone, "short", "left").filter(F.col("held") - F.coalesce("lone", F.lit(0)) >= F.col("needed"))
    named = materialize(living.select("node", "digest", F.col("first_id").alias("doc_id")), "living")
    read = shingle_sets(docs.join(named.select("doc_id").distinct(), "doc_id", "left_semi"), words)
    sets = materialize(read.join(named, ["doc_id", "digest"]).groupBy("node").agg(F.first("hashes").alias("hashes")), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        common = F.size(F.array_intersect("sx", "sy"))
        jaccard = common / (F.size("sx") + F.size("sy") - common)
        x, y = sets.select(F.col("node").alias("x"), F.col("hashes").alias("sx")), sets.select(F.col("node").alias("y"), F.col("hashes").alias("sy"))
        return pairs.join(x, "x").join(y, "y").filter(jaccard >= similarity - 1e-12).select(F.col("x").alias("a"), F.col("y").alias("b"))

    nodes = exact.groupBy("fp").agg(F.min("node").alias("fp_node"), F.max("shingles").alias("shingles"))
    links = near_links(nodes.filter(F.col("shingles") >= min_shingles).select("fp"), budget, whole, max_group)
    left, right = nodes.select(F.col("fp").alias("a"), F.col("fp_node").alias("x")), nodes.select(F.col("fp").alias("b"), F.col("fp_node").alias("y"))
    across = links.distinct().join(left, "a").join(right, "b").select("x", "y")
    within = exact.join(nodes.select("fp", "fp_node"), "fp").filter("node <> fp_node").select(F.col("fp_node").alias("x"), F.col("node").alias("y"))
    proposed = across.unionByName(within).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    roots = connected_components(confirmed(proposed))

    tokens, marks = token_sets(sets, similarity)
    marks = materialize(marks, "marks")
    for turn in range(rounds + 1):
        rooted = tokens.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        pairs = materialize(likely_pairs(rooted, marks, similarity, turn) if turn < rounds else remaining_pairs(rooted, marks, similarity), "pairs")
        near = materialize(confirmed(pairs), "near")
        if not near.isEmpty():
            roots = materialize(joined_roots(roots, near), "roots")

    placed = exact.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"), F.struct("first_id", "digest").alias("name"))
    least = placed.groupBy("root").agg(F.min("name").alias("least"))
    named = placed.join(least, "root").select("digest", F.col("least.first_id").alias("component_id"), (F.col("name") == F.col("least")).alias("least"))
    return join_one_per_key(marked, named, "digest").select("doc_id", "component_id", "digest", (F.col("least") & (F.col("doc_id") == F.col("component_id"))).alias("least"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
