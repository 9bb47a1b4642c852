"""The Jaccard join against all pairs, and the parts of its method."""

import random

import duckdb
import numpy as np
import pytest
from llm.test_operators import DOCS, awkward, by_union
from pyspark.sql import functions as F

from sonorum.llm import parity, simhash
from sonorum.llm.common import materialize

MIDDLE = "/root/testdata/sf0.01"


def shingles(text, size=4):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def components(rows, percent=85):
    """By every pair of texts that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    holders, pairs = {}, set()
    for i, own in sets.items():
        for s in own:
            holders.setdefault(s, []).append(i)
    met = {(a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1 :]}
    pairs = [(a, b) for a, b in met if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return by_union(sets, pairs), {i: len(s) for i, s in sets.items()}


def test_table_against_all_pairs(spark):
    rows = duckdb.sql(f"select doc_id, text from '{MIDDLE}/documents.parquet'").fetchall()
    want, sizes = components(rows)
    assert len(set(want.values())) < len(rows)
    got = parity.op12_jaccard_join(spark, MIDDLE).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (sizes[i], want[i]) for i in sizes}


@pytest.mark.parametrize("options", [{}, {"rounds": 0, "most": 1}])
def test_copies_of_every_similarity(spark, options):
    """Edits that leave texts on both sides of the threshold, groups of very many near copies, short texts, templates."""
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(3000)]
    texts = []
    for size in (1, 3, 4, 5, 8, 12, 20, 40, 90, 200, 700):
        for _ in range(4):
            base = rng.choices(vocabulary, k=size)
            texts.append(base)
            for edits in (1, 1, 2, 3, 5, 8, 13):
                other = list(base)
                for _ in range(edits if size > 20 else 1):
                    at = rng.randrange(len(other))
                    other[at : at + rng.choice((0, 1))] = [rng.choice(vocabulary)]
                texts.append(other if rng.random() < 0.7 else base + rng.choices(vocabulary, k=edits))
    shared = rng.choices(vocabulary, k=60)
    texts += [shared + rng.choices(vocabulary, k=20) for _ in range(30)]  # a template: common words, no links
    base = rng.choices(vocabulary, k=150)
    for _ in range(60):
        other = list(base)
        other[rng.randrange(150)] = rng.choice(vocabulary)
        texts.append(other)
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want, sizes = components(rows)
    got = parity.similar_sets(spark.createDataFrame(rows, "doc_id bigint, text string"), **options).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (sizes[i], want[i]) for i in sizes}


def test_edges(spark):
    rows = parity.similar_sets(awkward(spark)).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert len(rows) == 12 and by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)] and by[4] == [(1, 4)]
    assert [c for _, c in by[5] + by[6]] == [5, 5, 5] and sorted(n for n, _ in by[None]) == [0, 5] and {c for _, c in by[None]} == {None}
    assert parity.similar_sets(awkward(spark, [])).count() == 0


def test_null_ids_link_and_name_nothing(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(None, text, None, None, None), (None, text + " more", None, None, None), (7, "even " + text, None, None, None), (None, "other words of no text at all", None, None, None)]
    got = sorted((r["n_shingles"], r["component_id"]) for r in parity.similar_sets(spark.createDataFrame(rows, DOCS)).collect() if r["n_shingles"] > 10)
    assert got == [(57, 7), (58, 7), (58, 7)]


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(4)
    for n in (3, 50, 400):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.r_[a[n // 5 :], rng.integers(0, 1 << 63, n // 4).astype(np.uint64)]
        apart = len(np.setxor1d(parity.sketch(a, 7), parity.sketch(b, 7)))
        assert apart <= n // 5 + n // 4 and apart % 2 == (n // 5 + n // 4) % 2


def test_bands_hold_every_similar_pair_of_sizes():
    starts, apart = parity.bands(85)
    band = lambda n: int(np.searchsorted(starts, n, "right")) - 1
    for a in range(1, 1500):
        for b in range(a, a * 100 // 85 + 1):
            shared = -(-85 * (a + b) // 185)
            if shared <= a:
                assert band(b) - band(a) in (0, 1) and a + b - 2 * shared <= apart[band(a)]


@pytest.mark.parametrize("most", [1000, 40, 7])
def test_pairs_of_a_token_are_listed_once_whatever_the_blocks(spark, most):
    """400 nodes of one token: 150 of one root, some roots of several nodes, and single ones. A second token has the same nodes, a third others."""
    root = lambda k: 0 if k < 150 else 200 + k % 10 if k < 230 else k
    rows = [(t, k, root(k)) for t in (5, 6) for k in range(400)] + [(7, k, root(k)) for k in (1, 2, 300)]
    tokens = spark.createDataFrame(rows, "token bigint, node bigint, root bigint")
    marks = spark.createDataFrame([(k, 10, 0, [0] * simhash.BITMAP) for k in range(400)], "node bigint, n int, lone int, bits array<bigint>")
    listed = [(r["x"], r["y"]) for r in simhash.listed_pairs(tokens, marks, 0.8, most=most).collect()]
    want = [(a, b) for a in range(400) for b in range(a + 1, 400) if root(a) != root(b)]
    assert sorted(listed) == sorted([*want, (1, 300), (2, 300)])


def test_a_pair_of_many_common_tokens_is_listed_once(spark):
    """Tokens of different nodes, so that none stands for another: three nodes that share 40, each token with one more node of its own."""
    rows = [(node, node, token) for token in range(40) for node in (0, 1, 2, 100 + token)]
    tokens = spark.createDataFrame(rows, "node bigint, root bigint, token bigint").withColumn("token", F.xxhash64("token"))
    nodes = tokens.select("node").distinct()
    marks = nodes.select("node", F.when(F.col("node") < 3, 50).otherwise(500 + 50 * F.col("node")).cast("int").alias("n"), F.lit(0).alias("lone"), F.array_repeat(F.lit(0).cast("bigint"), simhash.BITMAP).alias("bits"))
    listed = sorted((r["x"], r["y"]) for r in simhash.listed_pairs(tokens, marks, 0.9, 1000, simhash.LEAST_TOKENS).collect() if r["y"] < 100)
    assert listed == [(0, 1), (0, 2), (1, 2)]
