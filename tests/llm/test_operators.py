"""Each corpus operator against brute force or its SQL, and on nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from oracle import compare
from pyspark.sql import functions as F

from sonorum.llm import chat_format, decontaminate, langid, linear, mixing, quality, registry, rule_ledger, simhash, suffix_dedup, toxicity, url_rules
from sonorum.llm import components
from sonorum.llm.components import connected_components

SMALL, MIDDLE, LARGE = (f"/root/testdata/sf{x}" for x in ("0.001", "0.01", "0.1"))
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators use inside.
CLASH = ("fp", "block", "size", "host", "path", "words", "leaks", "score", "label", "h", "slot", "component_id", "shingles")


def awkward(spark, rows=None):
    """Documents with nulls, blanks, long texts and repeats, and extra columns with clashing names."""
    words = random.Random(3).choices("alpha beta gamma delta epsilon zeta eta theta iota kappa".split(), k=30_000)
    base = [
        (1, None, None, None, None), (2, "", "en", "", 0), (3, " \n\t ", "en", "a", 4), (4, "one", None, "a", 3),
        (5, " ".join(words), "en", "b", 1), (6, " ".join(words), "en", "b", 1), (6, " ".join(words), "en", "b", 1),
        (None, "null id text with some words in it", "en", None, 5), (None, None, None, None, None),
        (7, "日本語 テキスト ñandú Äpfel", "xx", "c", 9), (8, "x" * 100_000, "en", "c", 9), (9, "\\ ### </turn> |||", "en", "c", 9),
    ] if rows is None else rows
    df = spark.createDataFrame(base, DOCS)
    for name in CLASH:
        df = df.withColumn(name, F.lit("x"))
    return df


def texts(sf):
    return duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet' order by doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    compare(registry.queries()[name](spark, SMALL), registry.oracle_sql()[name], SMALL)


# ---- 1 ----------------------------------------------------------------------------------------


def test_leaks_against_all_pairs(spark):
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.op1_decontaminate(spark, MIDDLE).collect()}
    items = duckdb.sql(f"select item_id, text from '{MIDDLE}/benchmark.parquet'").fetchall()
    grams = lambda t, n=5: set(zip(*(decontaminate.fold_words(t)[k:] for k in range(n))))
    own = {i: grams(t) for i, t in items}
    want = set()
    for doc, text in texts(MIDDLE):
        g = grams(text)
        want |= {(doc, i) for i, wanted in own.items() if len(g & wanted) >= 0.8 * len(wanted)}
    assert want and found == want


def test_leaks_with_a_changed_word_or_a_cut_end(spark):
    rng = random.Random(21)
    vocabulary = [f"v{k}" for k in range(800)]
    filler = [f"f{k}" for k in range(300)]
    items, rows, want = [], [], set()
    for size in (14, 15, 20, 27, 37, 46, 59):
        words = rng.choices(vocabulary, k=size)
        items.append((size, " ".join(words)))
        changed = [[*words[:k], "changed", *words[k + 1 :]] for k in range(size)]
        for text in (words, words[:-4], words[4:], *changed):
            want.add((len(rows), size))
            rows.append((len(rows), " ".join([*rng.choices(filler, k=60), *text, *rng.choices(filler, k=60)]), "en", "a", 1))
        rows.append((len(rows), " ".join([*rng.choices(filler, k=60), *words[: size // 2], *rng.choices(filler, k=60)]), "en", "a", 1))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = awkward(spark, rows)
    for max_words in (500_000, 40):
        found = decontaminate.contaminated(docs, decontaminate.split_items(benchmark), max_words=max_words, whole_share=decontaminate.WHOLE_SHARE).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want
    pairs = spark.createDataFrame([(1, " ".join(vocabulary[:20]), " ".join(vocabulary[20:28]))], "item_id bigint, question string, answer string")
    rows = [(k, " ".join([*vocabulary[: 20 + k], "changed", *vocabulary[21 + k : 28]]), "en", "a", 1) for k in range(8)] + [(8, " ".join(vocabulary[:20]), "en", "a", 1)]
    assert {r["doc_id"] for r in decontaminate.contaminated(awkward(spark, rows), pairs).collect()} == set(range(8))


def random_items(rng, vocabulary, n, longest=20):
    return [(i, rng.choices(vocabulary, k=rng.randint(3, longest)), rng.choices(vocabulary, k=3)) for i in range(n)]


def test_wand_equals_full_scores():
    rng = random.Random(5)
    vocabulary = [b"w%d" % k for k in range(60)] + [b"r%d" % k for k in range(600)]
    items = random_items(rng, vocabulary, 90)
    df = Counter(w for _, q, a in items for w in set(q + a))
    terms, (index,) = decontaminate.build_indexes(items, df, len(items), 14.0, 3)
    n_found = n_live = 0
    for _ in range(300):
        own = rng.choice(items)
        words = {*rng.sample(vocabulary, 12), *rng.sample(own[1], min(len(own[1]), rng.randint(0, 12)))}
        numbers = sorted(terms[w] for w in words if w in terms)
        full = defaultdict(float)
        for t in numbers:
            for place, score in zip(*index.lists[t][:2]):
                full[place] += score
        for threshold in (0.45, 0.6, 0.9):
            passages, blocks = index.live_blocks(np.full(len(numbers), 1), np.array(numbers), threshold)
            live = blocks[passages == 1].tolist()
            got = index.search(numbers, live, threshold) if live else []
            assert {p for p, _ in got} == {p for p, s in full.items() if s >= threshold}
            n_found, n_live = n_found + len(got), n_live + len(live)
    assert n_found > 50 and n_live < 0.5 * 900 * index.n_blocks


def test_leaks_do_not_depend_on_blocks_or_other_items(spark):
    """The same with any max_words, and with a long item among the others or alone."""
    rng = random.Random(6)
    vocabulary = [f"v{k}" for k in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(6, 40))), " ".join(rng.choices(vocabulary, k=rng.randint(3, 9)))) for i in range(30)]
    items.append((99, " ".join(rng.choices(vocabulary, k=700)), " ".join(rng.choices(vocabulary, k=8))))
    rows = []
    for i, q, a in items:
        for gap in (0, 5, 300):
            text = [*rng.choices(vocabulary, k=50), *q.split(), *rng.choices(vocabulary, k=gap), *a.split(), *rng.choices(vocabulary, k=50)]
            rows.append((len(rows), " ".join(text), "en", "a", 1))
    docs = awkward(spark, rows)
    frame = spark.createDataFrame(items, "item_id bigint, question string, answer string")
    found = []
    for max_words in (500_000, 900, 100):
        found.append({tuple(r) for r in decontaminate.contaminated(docs, frame, max_words=max_words).collect()})
        with_column = decontaminate.with_leaks(docs, frame, max_words=max_words).select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.item_id").collect()
        assert {tuple(r) for r in with_column} == {r[:2] for r in found[-1]}
    assert found[0] == found[1] == found[2]
    assert {r[:2] for r in found[0]} >= {(k, items[k // 3][0]) for k in range(len(rows)) if k % 3 < 2}
    alone = decontaminate.contaminated(docs, frame.filter("item_id = 3")).collect()
    assert {r["doc_id"] for r in alone} == {r[0] for r in found[0] if r[1] == 3} == {9, 10}


def test_no_table_between_blocks_of_items_holds_a_text(spark, monkeypatch):
    rng = random.Random(8)
    items = [(k, " ".join(rng.choices([f"v{j}" for j in range(900)], k=40))) for k in range(8)]
    rows = [(d, f"before {items[d % 8][1]} after" if d % 3 else "nothing of these", "en", "a", 1) for d in range(30)]
    rows += [rows[1]] * 3 + [(None, rows[1][1], None, None, None), (None, None, None, None, None)]
    written, real = [], decontaminate.materialize
    monkeypatch.setattr(decontaminate, "materialize", lambda df, what: written.append(df.columns) or real(df, what))
    docs = spark.createDataFrame(rows, DOCS).withColumn("leak", F.lit("x")).withColumn("pair", F.create_map(F.lit(1), F.lit(2)))
    split = decontaminate.split_items(spark.createDataFrame(items, "item_id bigint, text string"))
    one, many = (decontaminate.with_leaks(docs, split, "found", max_words=n) for n in (10_000, 60))
    assert one.columns == many.columns == [*docs.columns, "found"]
    assert len(written) > 3 and not any("text" in columns for columns in written)
    facts = [sorted((r["doc_id"] is None, r["doc_id"] or 0, [x["item_id"] for x in r["found"]]) for r in df.collect()) for df in (one, many)]
    assert facts[0] == facts[1] and len(facts[0]) == len(rows) and sum(map(len, (f[2] for f in facts[0]))) == 24


def test_odd_bytes_do_not_stop_the_operators(spark):
    odd = spark.sql("select 1L as doc_id, cast(unhex('61FF6220C3') as string) as text, 'en' as lang, 'a' as source, 1L as n_chars union all select 2L, 'plain words', 'en', 'a', 1L")
    items = spark.createDataFrame([(1, "plain words", "here")], "item_id bigint, question string, answer string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id bigint, quality int, toxic int")
    for found in (
        decontaminate.with_leaks(odd, items), toxicity.classify_toxicity(odd, labels, toxicity.QUERY_CATEGORIES), quality.classify_quality(odd, labels),
        langid.identify_languages(odd), simhash.near_duplicates(odd), simhash.similar_documents(odd, 7, 2), rule_ledger.ledger(odd), mixing.mix_sources(odd),
    ):
        assert len(found.drop("text").collect()) == 2
    kept = suffix_dedup.remove_repeated_windows(odd).select("doc_id", F.hex("text").alias("h"), "n_bytes").collect()
    assert {r["doc_id"]: (r["h"], r["n_bytes"]) for r in kept}[1] == ("61FF6220C3", 5)


def test_leak_edges(spark):
    question, answer = "what is the tallest mountain on the northern island", "it is mount example of the ridge"
    items = spark.createDataFrame([(1, question, answer), (2, None, None), (3, "", "..."), (4, None, answer), (1, question, answer)], "item_id bigint, question string, answer string")
    body = "filler words go here " * 40
    rows = [(1, f"{body} {question} {answer} {body}", "en", "a", 1), (2, f"{body} {question} {body}", "en", "a", 1), (3, None, "en", "a", 1), (4, "", "en", "a", 1), (1, f"{body} {question} {answer} {body}", "en", "a", 1)]
    for max_words in (500_000, 20):
        got = decontaminate.contaminated(awkward(spark, rows), items, max_words=max_words).collect()
        assert Counter((r["doc_id"], r["item_id"]) for r in got) == {(1, 1): 4, (1, 4): 2}
    assert decontaminate.contaminated(awkward(spark), items).count() == 0
    assert decontaminate.contaminated(awkward(spark), items.limit(0)).count() == 0
    assert decontaminate.contaminated(awkward(spark, []), items).count() == 0


# ---- 2 ----------------------------------------------------------------------------------------


def water(sizes, weights=(5, 2, 1), share=1.5):
    names, fixed = sorted(sizes), {}
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    budget = share * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in fixed]
        left = budget - sum(fixed.values())
        target = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if target[s] > 2 * sizes[s]]
        if not over:
            return target | fixed
        fixed |= {s: 2 * sizes[s] for s in over}


def test_mix_meets_targets(spark):
    rows = mixing.op2_source_mix(spark, MIDDLE).collect()
    again = mixing.op2_source_mix(spark, MIDDLE).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    sources = dict(duckdb.sql(f"select doc_id, source from '{MIDDLE}/documents.parquet'").fetchall())
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    words = {d: len(t.encode().split()) for d, t in texts(MIDDLE)}
    for r in rows:
        s = sources[r["doc_id"]]
        assert r["size"] == words[r["doc_id"]] and r["taken"] <= 2 * r["size"]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
    want = water(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * want[s] + 1e-6
        assert abs(taken[s] - target[s]) <= 1


def test_mix_edges(spark):
    rows = mixing.mix_sources(awkward(spark)).collect()
    assert len(rows) == 12 and all(r["copies"] in (0, 1, 2) for r in rows)
    assert {r["source"] for r in rows} == {None, "", "a", "b", "c"}
    size = {(r["doc_id"], r["source"]): r["size"] for r in rows}
    assert size[1, None] == size[2, ""] == size[3, "a"] == 0 and size[5, "b"] == 30_000 and size[8, "c"] == 1
    assert all(r["copies"] == 0 for r in rows if not r["size"])
    of_b = [r for r in rows if r["source"] == "b"]
    assert abs(sum(r["taken"] for r in of_b) - of_b[0]["target"]) <= 15_000  # whole documents of 30,000 words
    assert mixing.mix_sources(awkward(spark, [])).count() == 0
    assert all(r["taken"] == 0 for r in mixing.mix_sources(awkward(spark, [(1, None, None, None, None)])).collect())


def all_sums(lengths, counts):
    sums = {0}
    for n, c in zip(lengths, counts):
        sums = {s + n * k for s in sums for k in range(2 * c + 1)}
    return sums


def test_plan_is_nearest_of_all_sums():
    rng = random.Random(2)
    for _ in range(600):
        top = rng.choice([10, 60, 400, 200_000, 30_000_000])
        lengths = rng.sample(range(1, top + 1), rng.randint(1, 5))
        counts = [rng.randint(0, 3) for _ in lengths]
        target = rng.random() * 2 * sum(n * c for n, c in zip(lengths, counts))
        options = rng.choice([{}, {"reaches": (16, 64, 1 << 12)}])
        taken = mixing.plan_source(lengths, counts, target, **options)
        assert all(0 < k <= 2 * counts[lengths.index(n)] for n, k in taken.items())
        assert abs(sum(n * k for n, k in taken.items()) - target) <= min(abs(s - target) for s in all_sums(lengths, counts)) + 1e-6


def test_plans_of_long_and_of_single_documents():
    assert mixing.plan_source([70_000, 100_000, 101_000], [1, 1, 1], 170_000) == {70_000: 1, 100_000: 1}
    assert mixing.plan_source([100], [1], 199) == {100: 2} and mixing.plan_source([100], [1], 149) == {100: 1}
    assert mixing.plan_source([], [], 0) == mixing.plan_source([0], [5], 0) == {}
    rng = random.Random(3)
    lengths = rng.sample(range(1, 60_000), 3000)
    counts = [rng.randint(1, 40) for _ in lengths]
    total = sum(n * c for n, c in zip(lengths, counts))
    for share in (0.1, 0.9, 1.5, 2.0):
        taken = mixing.plan_source(lengths, counts, share * total)
        assert abs(sum(n * k for n, k in taken.items()) - share * total) <= 0.5
    even = mixing.plan_source([2 * n for n in lengths], counts, total + 1)  # only even sums can be reached
    assert abs(2 * sum(n * k for n, k in zip(lengths, [even.get(2 * n, 0) for n in lengths])) - total - 1) <= 1


# ---- 3, 4, 10 ---------------------------------------------------------------------------------


def test_toxicity_on_unseen_rows(spark):
    """Never or always toxic fails both. A smaller table has too few toxic rows to learn from."""
    docs, labels = spark.read.parquet(f"{LARGE}/documents.parquet"), spark.read.parquet(f"{LARGE}/labels.parquet")
    unseen = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    out = toxicity.classify_toxicity(docs, labels.filter(~unseen), toxicity.QUERY_CATEGORIES)
    rows = out.join(labels.filter(unseen).select("doc_id", F.col("toxic").alias("y")), "doc_id").collect()
    hits = sum(r["toxic"] and r["y"] for r in rows)
    assert hits / sum(r["y"] for r in rows) >= 0.85 and hits / sum(r["toxic"] for r in rows) >= 0.95
    assert all(0 <= r["p_toxic"] <= 1 for r in rows)


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (5, None, None), (None, 1, 1), (7, 1, 1), (7, 1, 1)], "doc_id bigint, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.filter("toxic = 0")):
        rows = toxicity.classify_toxicity(awkward(spark), known, toxicity.QUERY_CATEGORIES).collect()
        assert Counter(r["doc_id"] for r in rows) == Counter([1, 2, 3, 4, 5, 6, 6, None, None, 7, 8, 9])
        of = defaultdict(set)
        for r in rows:
            of[r["doc_id"]].add((r["p_low_quality"], r["p_toxic"]))
        assert of[1] == of[2] == of[3] and of[5] == of[6] and len(of[6]) == 1  # no words; equal texts
    assert not any(r["toxic"] for r in rows)
    assert toxicity.classify_toxicity(awkward(spark, []), labels, toxicity.QUERY_CATEGORIES).count() == 0


def plain_chain(names, texts, labels, folds, n_folds):
    """The chain with dense matrices, row by row."""
    x = np.array([[n in t for n in names] for t in texts], float)
    chances, links = np.zeros((len(texts), 0)), []
    for y in labels.T:
        def model(rows):
            one, none = 1 + x[rows][y[rows]].sum(axis=0), 1 + x[rows][~y[rows]].sum(axis=0)
            r = np.log(one / one.sum() / (none / none.sum()))
            z = np.c_[x * r, chances, np.ones(len(x))]
            w, dual = np.zeros(z.shape[1]), np.zeros(len(x))
            most = 0.1 * np.where(y, len(rows) / (2 * y[rows].sum()), len(rows) / (2 * (~y[rows]).sum()))
            order = np.random.default_rng(3)
            for _ in range(10):
                for i in rows[order.permutation(len(rows))]:
                    s = 1 if y[i] else -1
                    new = min(max(dual[i] - (s * (z[i] @ w) - 1) / (z[i] @ z[i]), 0), most[i])
                    w, dual[i] = w + (new - dual[i]) * s * z[i], new
            return z @ w
        out = np.zeros(len(x))
        for fold in range(n_folds):
            out[folds == fold] = model(np.flatnonzero(folds != fold))[folds == fold]
        slope, shift = toxicity.fit_sigmoid(out, y)
        links.append(1 / (1 + np.exp(-(slope * model(np.arange(len(x))) + shift))))
        chances = np.c_[chances, 1 / (1 + np.exp(-(slope * out + shift)))]
    return chances


def sparse_chain(names, texts, labels, folds, n_folds):
    place = {n: k for k, n in enumerate(names)}
    rows = [np.array(sorted(place[w] for w in t)) for t in texts]
    chances, links = np.zeros((len(texts), 0)), []
    for y in labels.T:
        margins = np.zeros(len(texts))
        for fold in range(n_folds):
            margins[folds == fold], _ = toxicity.fit_fold(rows, chances, y, folds, fold, len(names), 20_000)
        _, model = toxicity.fit_fold(rows, chances, y, folds, n_folds, len(names), 20_000)
        links.append(toxicity.finish_link(margins, y, model, len(names), chances.shape[1]))
        chances = np.c_[chances, links[-1].chances(margins)]
    return chances, toxicity.Chain(names, links)


def test_chain_equals_a_dense_version():
    rng = np.random.default_rng(4)
    names = sorted(b"n%d" % k for k in range(12)) + [b"zbad", b"zfine"]
    texts_ = [{names[k] for k in rng.integers(0, 12, 4)} | {names[12 + (rng.random() < 0.5)]} for _ in range(120)]
    labels = np.array([(b"zbad" in t, (b"zbad" in t) != (rng.random() < 0.1)) for t in texts_])
    folds = rng.integers(0, 3, 120)
    got, chain = sparse_chain(names, texts_, labels, folds, 3)
    assert np.allclose(got, plain_chain(names, texts_, labels, folds, 3), atol=2e-3)
    assert len(chain.links[1].earlier) == 1 and chain.links[1].earlier[0] > 0
    bad, fine = chain.chances([b"zbad n1", b"zfine n1"])
    assert bad.min() > 0.8 and fine.max() < 0.2


def test_features_of_the_model_are_those_of_the_text():
    found = sorted(toxicity.word_set("abcdef abcxyz abcd Abcdq x"))
    links = [toxicity.Link(np.arange(1.0, len(found) + 1), np.zeros(0), 0.0, 1.0, 0.0)]
    chain = toxicity.Chain(found, links)
    for text in ("abcdef abcxyz", "abcd abcdef abcdq", "", None, "x y z"):
        assert [chain.names[k] for k in chain.features(text)] == sorted(toxicity.word_set(text) & set(found))
    assert b"abcd*2" in found and b"abcd*4" not in found


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = quality.op4_quality(spark, MIDDLE).join(labels, "doc_id", "left").collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in rows if r["held_out"] and r["quality"] is not None]
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.95


def test_coordinate_descent_reaches_the_dense_optimum():
    """The dual of the hinge loss at its optimum: a dense fit by small steps finds no better primal value."""
    rng = np.random.default_rng(8)
    rows = [np.unique(rng.integers(0, 15, 5)) for _ in range(60)]
    y = np.array([(3 in r) or rng.random() < 0.2 for r in rows])
    values = [np.ones(len(r)) / np.sqrt(len(r)) for r in rows]
    x = np.zeros((60, 16))
    for i, (r, v) in enumerate(zip(rows, values)):
        x[i, r], x[i, 15] = v, 1.0
    s = np.where(y, 1.0, -1.0)
    cost = np.where(y, 60 / (2 * y.sum()), 60 / (2 * (~y).sum()))
    value = lambda w: 0.5 * w @ w + (cost * np.maximum(0, 1 - s * (x @ w))).sum()
    got = value(linear.dual_coordinate_descent(rows, values, y, 15, epochs=400))
    w, best = np.zeros(16), np.inf
    for step in range(1, 40_000):
        w = w - (w - x.T @ (cost * s * (s * (x @ w) < 1))) / (step + 10)
        best = min(best, value(w))
    assert got <= best * 1.001


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (5, None), (7, 1), (7, 1)], "doc_id bigint, quality int")
    for known in (labels, labels.limit(0)):
        rows = quality.classify_quality(awkward(spark), known).collect()
        assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
        of = defaultdict(set)
        for r in rows:
            of[r["doc_id"]].add((r["score"], r["predicted"]))
            assert r["predicted"] == int(r["score"] >= 0.5)
        assert of[1] == of[2] and of[5] == of[6] and len(of[6]) == 1
    assert quality.classify_quality(awkward(spark, []), labels).count() == 0


def test_languages_on_held_out_rows(spark):
    truth = dict(duckdb.sql(f"select doc_id, lang from '{MIDDLE}/documents.parquet'").fetchall())
    rows = langid.op10_language_id(spark, MIDDLE).collect()
    assert len(rows) == 1000
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark):
    rows = {r["doc_id"]: r for r in langid.identify_languages(awkward(spark)).collect()}
    assert all(rows[d]["lang_pred"] == "und" and rows[d]["score"] == 0 for d in (1, 2, 3))
    assert rows[7]["lang_pred"] in ("xx", "en")
    assert langid.identify_languages(awkward(spark, [])).count() == 0
    assert langid.identify_languages(awkward(spark, [(1, "text", None, None, 1)])).first()["lang_pred"] == "und"


def test_vectors_equal_a_plain_version():
    p = langid.Profiler(256, 5)
    for text in ("the cat, The Hat", "приветик мир", "日本語 テキスト", "aé ßx"):
        codes = [c if c.isalpha() else "" for c in f" {text.lower()} "]
        letter = lambda c: np.random.default_rng((5, ord(c) if c else 0)).integers(0, 2, 256, np.int8) * 2 - 1
        total = sum(np.roll(letter(codes[i - 1]), 2) * np.roll(letter(codes[i]), 1) * letter(codes[i + 1]).astype(int) for i in range(1, len(codes) - 1) if codes[i])
        assert np.allclose(p.vector(text), total / np.linalg.norm(total), atol=1e-5)
    a, b = p.vector("приветик мир"), p.vector("бсюжжчэц эщо")
    assert abs(a @ b) < 0.4  # other letters of one script are other letters


def test_trigrams_count_letters_once():
    p = langid.Profiler(64, 1)
    grams, counts = p.trigrams("ab ab")
    assert counts.sum() == 4 and len(grams) == 2
    assert not len(p.trigrams("12 !?")[0])


# ---- 5, 6, 7 ----------------------------------------------------------------------------------


def test_url_rules_against_all_rules(spark):
    rng = random.Random(8)
    labels_ = ["a", "b", "net", "org", "x-y"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab", "/é"]
    urls = []
    for i in range(600):
        host = ".".join(rng.choices(labels_, k=rng.randint(1, 4)))
        urls.append((i % 500, f"{rng.choice(['http', 'HTTPS'])}://{rng.choice([host, host.upper()])}{rng.choice(paths)}{rng.choice(['', '?q=/a', '#/a/b'])}"))
    urls += [(900, None), (901, "no scheme"), (902, "://"), (903, "x://a.net/a\n/b")]
    rules = list({(".".join(rng.choices(labels_, k=rng.randint(1, 3))), rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(40)}.items())
    rows = [(h, p, v) for (h, p), v in rules] + [(None, "/", "block"), ("a", None, "block")]
    frame = spark.createDataFrame(urls, "page_id bigint, url string").withColumn("host", F.lit("x")).withColumn("rule", F.lit(1))
    want = Counter()
    for page, url in urls:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = rest[:cut].lower()
        path = rest[cut:]
        path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
        fits = [(len(h + p), len(h), h + p, v) for (h, p), v in rules if ("." + host).endswith("." + h) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        want[page, host, path, best[2], best[3]] += 1
    for shard in (500_000, 7):
        got = url_rules.judge_urls(frame, spark.createDataFrame(rows, "host string, path string, verdict string"), rows_per_shard=shard)
        assert Counter(tuple(r) for r in got.select("page_id", "host", "path", "rule", "verdict").collect()) == want
    assert url_rules.judge_urls(frame.limit(0), spark.createDataFrame(rows, "host string, path string, verdict string")).count() == 0
    none = url_rules.judge_urls(frame, spark.createDataFrame([], "host string, path string, verdict string"))
    assert none.filter("rule is null and verdict = 'allow'").count() == len(urls)


def count_repeats(words):
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    return len({i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(8)})


def test_ledger_edges(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices("ab", k=rng.randint(0, 40))), "en", "a", 1) for i in range(40)]
    got = {r["doc_id"]: r for r in rule_ledger.ledger(awkward(spark, rows)).collect()}
    assert all(got[i]["n_repeat_words"] == count_repeats(t.split()) for i, t, *_ in rows)
    odd = {r["doc_id"]: r for r in rule_ledger.ledger(awkward(spark)).collect()}
    assert odd[1]["n_words"] == odd[2]["n_words"] == odd[3]["n_words"] == 0 and odd[1]["failed"] & 1
    assert odd[9]["n_symbols"] == 8 and odd[5]["n_words"] == 30_000
    lines = rule_ledger.ledger(awkward(spark, [(1, "a\n \na\n\na b\na", "en", "a", 1)])).first()
    assert (lines["n_lines"], lines["n_dup_lines"]) == (4, 2)
    assert rule_ledger.ledger(awkward(spark, [])).count() == 0


def test_policies_and_ablation(spark):
    rows = [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4), (6, 5)]
    ledger = spark.createDataFrame(rows, "doc_id int, failed int")
    assert [r["doc_id"] for r in rule_ledger.apply_policy(ledger, "v1").filter("kept").collect()] == [1, 5]
    found = {r["rule"]: (r["n_failed"], r["n_only"], r["seen_with"]) for r in rule_ledger.ablation(ledger, "v2").collect()}
    assert found["few_words"] == (3, 1, 7) and found["repeated_words"] == (2, 1, 3) and found["symbols"] == (2, 1, 5)
    assert found["word_length"] == (0, 0, 0)
    assert {r["n_failed"] for r in rule_ledger.ablation(ledger.limit(0), "v2").collect()} == {0}


def test_chat_round_trip(spark):
    pieces = ["\\", "#", "### Assistant: ", "</turn>", " </turn>\n", "<\\/turn>", "a", "\n", "", "é", "$1", ": ", "=x"]
    rng = random.Random(1)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 5)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool: <x>", "="]), "".join(rng.choices(pieces, k=rng.randint(0, 8)))))
    rows += [(100, None, None, None), (100, 1, "user", None), (None, 1, "user", "x"), (100, 1, "user", None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(1)).withColumn("segments", F.lit(2))
    chats = chat_format.format_chats(df).withColumn("f", chat_format.joined(F.col("segments"))).withColumn("parsed", chat_format.parse_chats(F.col("f")))
    seen = {r["conv_id"]: r for r in chats.collect()}
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(seen) == set(by)
    for conv, turns in by.items():
        assert [(t["role"], t["text"]) for t in seen[conv]["parsed"]] == [(r, t) for _, _, r, t in sorted(turns)]
        for segment in seen[conv]["segments"][1::3]:
            assert "###" not in segment["text"] and "</turn>" not in segment["text"]
    assert chat_format.format_chats(df.limit(0)).count() == 0


@pytest.mark.parametrize("template", [
    chat_format.Template(footer=" <|end|>\n"),
    chat_format.Template(names={"user": "human"}, opening="<|turn|>", colon="<|says|>", footer="<|end|>", loss_roles=("user", "tool")),
])
def test_other_templates_read_back(spark, template):
    rng = random.Random(2)
    pieces = ["\\", "#", "###", "<|end|>", "<|turn|>", "<|says|>", " <|end|>\n", "<|end|", "|>", "<", "\\f", "\\d", ": ", "é"]
    rows = [(c, t, rng.choice(["user", "assistant", "tool<|says|>: ", "", "="]), "".join(rng.choices(pieces, k=rng.randint(0, 6)))) for c in range(60) for t in range(4)]
    chats = chat_format.format_chats(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"), template)
    text = chat_format.joined(F.col("segments"))
    mask = chat_format.loss_mask(F.col("segments"))
    got = {r["conv_id"]: r for r in chats.select("conv_id", chat_format.parse_chats(text, template).alias("turns"), chat_format.masked_text(text, mask, template).alias("loss")).collect()}
    for conv in range(60):
        said = [(r, x) for c, _, r, x in rows if c == conv]
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == said
        assert got[conv]["loss"] == "".join(x for r, x in said if r in template.loss_roles)


def test_ambiguous_templates_are_errors():
    for wrong in ({"footer": "\n", "controls": ("###",)}, {"colon": ""}, {"footer": "a\\"}, {"names": {"user": "a: b"}}, {"controls": ("aba", "</turn>"), "footer": "ba</turn>"}, {"names": {"a": "X", "b": "X"}}):
        with pytest.raises(ValueError):
            chat_format.Template(**wrong)


def test_very_long_roles_and_texts(spark):
    long = "r: \\#</turn>" * 10_000
    df = spark.createDataFrame([(1, 0, long, "x"), (1, 1, "user", long)], "conv_id int, turn int, role string, text string")
    chats = chat_format.format_chats(df).select(chat_format.parse_chats(chat_format.joined(F.col("segments"))).alias("turns")).first()
    assert [tuple(t) for t in chats["turns"]] == [(long, "x"), ("user", long)]


def test_states_are_not_roles(spark):
    """At most two questions before an answer."""
    template = chat_format.Template(start="s0", moves=(("s0", "user", "s1"), ("s1", "user", "s2"), ("s1", "assistant", "s0"), ("s2", "assistant", "s0")), ends=("s0",))
    turns = {1: "ua", 2: "uua", 3: "uuua", 4: "uau", 5: "au"}
    rows = [(c, t, {"u": "user", "a": "assistant"}[r], "x") for c, told in turns.items() for t, r in enumerate(told)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = {r["conv_id"]: (r["valid"], r["bad_turn"]) for r in chat_format.format_chats(df, template).collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (False, 2), 4: (False, None), 5: (False, 0)}


def test_chat_turn_order(spark):
    rows = [(1, 0, "system"), (1, 1, "user"), (1, 2, "assistant"), (2, 0, "user"), (2, 1, "user"), (2, 2, "assistant"), (3, 0, "user")]
    df = spark.createDataFrame([(c, t, r, "x") for c, t, r in rows], "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: (r["valid"], r["bad_turn"]) for r in chat_format.format_chats(df).collect()}
    assert got == {1: (True, None), 2: (False, 1), 3: (False, None)}


# ---- 8, 9 -------------------------------------------------------------------------------------


def by_union(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 560)]
    want = by_union({x for link in links for x in link}, links)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {n: r for n, r in want.items() if n != r}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_links_of_one_task_are_contracted_in_one_pass(spark, monkeypatch):
    rng = random.Random(4)
    links = [(f"n{rng.randint(0, 300):03}", f"n{rng.randint(0, 300):03}") for _ in range(250)] + [(f"z{k:03}", f"z{k + 1:03}") for k in range(200)]
    want = {n: r for n, r in by_union_of_names(links).items() if n != r}
    written, write = [], components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, what: written.append(what) or write(df, what))
    for at_once, most in ((components.AT_ONCE, 1), (7, 99)):
        written.clear()
        df = spark.createDataFrame(links, "a string, b string").coalesce(1)
        rows = connected_components(df, at_once=at_once).collect()
        assert {r["node"]: r["root"] for r in rows} == want and len(rows) == len(want)
        assert len(written) <= most


def test_few_links_of_many_tasks_take_two_passes(spark, monkeypatch):
    links = [(k, k + 1) for k in range(300)] + [(500, k) for k in range(501, 560)]
    want = {n: r for n, r in by_union({x for link in links for x in link}, links).items() if n != r}
    written, write, key = [], components.materialize, "spark.sql.adaptive.coalescePartitions.enabled"
    monkeypatch.setattr(components, "materialize", lambda df, what: written.append(what) or write(df, what))
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        rows = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    finally:
        spark.conf.set(key, before)
    assert {r["node"]: r["root"] for r in rows} == want and len(rows) == len(want)
    assert len(written) == 2


def by_union_of_names(links):
    names = sorted({x for link in links for x in link})
    number = {x: k for k, x in enumerate(names)}
    return {names[n]: names[r] for n, r in by_union(range(len(names)), [(number[a], number[b]) for a, b in links]).items()}


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_hubs_are_dealt_over_tasks(spark):
    """A star of 3,000 links, and chains; as a hot node and as any other."""
    rows = [(1, k) for k in range(2, 3002)] + [(5000 + k, 5001 + k) for k in range(40)]
    links = spark.createDataFrame(rows, "a bigint, b bigint")
    want = {k: 1 for k in range(2, 3002)} | {5001 + k: 5000 for k in range(40)}
    for hot_from in (100, 10_000):
        assert {r["node"]: r["root"] for r in connected_components(links, hot_from).collect()} == want


def test_simhash_against_all_pairs(spark):
    rows = simhash.op8_simhash(spark, SMALL).collect()
    fps = {d: plain_fingerprint(t) for d, t in texts(SMALL)}
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in rows} == fps
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    assert {r["doc_id"]: r["component_id"] for r in rows} == by_union(fps, links)


def test_spark_hashes_shingles_alike(spark):
    said = "a bc d"
    assert spark.range(1).select(F.xxhash64(F.lit(said)).alias("h")).first()["h"] % 2**64 == xxhash.xxh64_intdigest(said.encode(), 42)


@pytest.mark.parametrize(("budget", "whole", "most"), [(2, 1, 4096), (2, 1, 3), (4, 2, 4096), (4, 2, 8)])
def test_trie_links_connect_all_near_pairs(spark, budget, whole, most):
    rng = random.Random(budget)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(6):
            fps.add(f)
            for _ in range(rng.randint(0, budget + 1)):
                f ^= 1 << rng.randrange(64)
    fps |= {k for k in range(20)}
    signed = {f - (1 << 64) if f >= 1 << 63 else f for f in fps}
    links = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= budget]
    got = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), budget, whole, most).collect()
    assert all(0 < ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= budget for r in got)
    assert by_union(signed, [(r["a"], r["b"]) for r in got]) == by_union(signed, links)


def test_simhash_edges(spark):
    rows = simhash.near_duplicates(awkward(spark)).collect()
    assert len(rows) == 12
    of = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert of[1] == of[2] == of[3] == 1 and of[5] == of[6] == 5 and of[4] == 4
    assert simhash.near_duplicates(awkward(spark, [])).count() == 0


def test_similar_documents(spark):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(5000)]
    rows, near = [], []
    for k in range(30):
        own = rng.choices(words, k=600)
        rows.append((10 * k, " ".join(own), "en", "a", 1))
        own[rng.randrange(600)] = "changed"
        rows.append((10 * k + 1, " ".join(own), "en", "a", 1))
        near.append((10 * k, 10 * k + 1))
        rows.append((10 * k + 2, " ".join(own[:200] + rng.choices(words, k=400)), "en", "a", 1))
    rows += [(1000, rows[0][1].upper(), "en", "a", 1), (1001, "few words", "en", "a", 1), (1002, None, "en", "a", 1), (None, rows[0][1], "en", "a", 1)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(awkward(spark, rows), 7, 2, min_shingles=9).collect()}
    want = by_union({r[0] for r in rows if r[0] is not None}, [*near, (0, 1000)])
    assert got == want
    assert simhash.similar_documents(awkward(spark, []), 7, 2).count() == 0


def shingles_of(text, size=5):
    words = text.lower().split()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or {tuple(words)}


def similar_pairs(rows):
    """(lesser id, greater id) -> Jaccard similarity of at least 0.8, by all pairs that share a shingle."""
    sets = {r[0]: shingles_of(r[1]) for r in rows}
    holders = defaultdict(list)
    for i, own in sets.items():
        for g in own:
            holders[g].append(i)
    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    found = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in pairs}
    return {p: j for p, j in found.items() if j >= 0.8}


def same_as_all_pairs(spark, rows, **options):
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(awkward(spark, rows), 7, 2, min_shingles=9, **options).collect()}
    return got == by_union({r[0] for r in rows}, list(similar_pairs(rows)))


def edited(rng, words, spread, more, vocabulary):
    out = list(words)
    for k in rng.sample(range(len(out)), spread):
        out[k] = rng.choice(vocabulary)
    return out + rng.choices(vocabulary, k=more)


def test_every_true_link_of_a_large_group_joins(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(5000)]
    base = rng.choices(vocabulary, k=150)
    rows = [(k, " ".join(edited(rng, base, rng.randint(2, 4), 0, vocabulary)), "en", "a", 1) for k in range(120)]
    assert len(similar_pairs(rows)) > 100
    assert same_as_all_pairs(spark, rows)


def planted_pairs(rng, each):
    """Pairs of texts of 30 to 500 words, with words appended or changed here and there, from under 0.8 to nearly 1."""
    vocabulary = [f"w{k}" for k in range(5000)]
    rows = []
    for size in (30, 60, 150, 500):
        for share in (0.01, 0.02, 0.04, 0.08, 0.12, 0.16, 0.2, 0.24):
            for k in range(2 * each):
                words = rng.choices(vocabulary, k=size)
                spread, more = (0, max(1, int(share * size))) if k % 2 else (max(1, int(share * size / 9)), 0)
                rows += [(len(rows) + j, " ".join(w), "en", "a", 1) for j, w in enumerate((words, edited(rng, words, spread, more, vocabulary)))]
    return rows


def test_near_copies_of_every_similarity_are_found(spark):
    rows = planted_pairs(random.Random(12), 5)
    assert len(similar_pairs(rows)) > 200
    assert same_as_all_pairs(spark, rows)


def test_short_near_copies(spark):
    rows = []
    for size in range(1, 13):
        words = [f"s{size}x{k}" for k in range(size)]
        for text in (words, [*words, "more"], [*words, "other"], ["first", *words[1:]]):
            rows.append((len(rows), " ".join(text), "en", "a", 1))
    linked = {(len(rows[a][1].split()), len(rows[b][1].split())) for a, b in similar_pairs(rows)}
    assert {(8, 9), (9, 10), (10, 11)} <= linked and (7, 8) not in linked
    assert same_as_all_pairs(spark, rows)


def plain_removal(rows, window=50):
    seen, out = {}, Counter()
    for i, data in sorted((r for r in rows), key=lambda r: (r[0] is None, r[0] or 0)):
        starts = [k for k in range(len(data) - window + 1) if seen.get(data[k : k + window], i) != i]
        covered = {k + j for k in starts for j in range(window)}
        kept = bytes(b for k, b in enumerate(data) if k not in covered)
        spans = sum(k not in covered and k + 1 in covered for k in range(-1, len(data)))
        out[i, len(data), len(covered), spans, hashlib.sha256(kept).hexdigest()] += 1
        for k in range(len(data) - window + 1):
            seen.setdefault(data[k : k + window], i)
    return out


@pytest.mark.parametrize("options", [{}, {"block_bytes": 20_000, "bucket_bytes": 30_000}, {"block_bytes": 20_000, "bucket_bytes": 9_000, "hot_blocks": 1}])
def test_suffixes_against_all_windows(spark, options):
    got = suffix_dedup.remove_repeated_windows(spark.read.parquet(f"{SMALL}/documents.parquet"), **options)
    rows = got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, rows)) == plain_removal([(d, (t or "").encode()) for d, t in texts(SMALL)])


def test_suffix_edges(spark):
    line = "Licensed under some terms, see the file for details, twice."
    rows = [(3, "é" * 40 + line, "en", "a", 1), (1, line + "x", "en", "a", 1), (2, "é" * 40, "en", "a", 1), (4, None, None, None, None), (5, "", "en", "a", 0), (6, "ab" * 3000, "en", "a", 1), (7, "ab" * 40, "en", "a", 1), (7, "ab" * 40, "en", "a", 1), (8, line[:49], "en", "a", 1), (None, line, "en", "a", 1)]
    for options in ({}, {"block_bytes": 500, "bucket_bytes": 700}, {"block_bytes": 500, "bucket_bytes": 300, "hot_blocks": 1}):
        out = suffix_dedup.remove_repeated_windows(awkward(spark, rows), keep=("source", "block"), **options).collect()
        got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out)
        assert got == plain_removal([(d, (t or "").encode()) for d, t, *_ in rows])
    assert suffix_dedup.remove_repeated_windows(awkward(spark)).count() == 12
    assert suffix_dedup.remove_repeated_windows(awkward(spark, [])).count() == 0


def test_messages_stay_large_at_any_size(spark):
    for total in (10**7, 10**10, 10**12, 10**14):
        blocks, buckets = suffix_dedup.deal_sizes(total, 4 << 20, 8 << 20)
        assert total / 16 / (blocks * buckets) >= 999 and blocks * buckets <= total / 15_900 + 1
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    blocks, buckets = suffix_dedup.deal_sizes(total, 2_000, 3_000)  # as of 1,000 times the input
    assert total / 16 / (blocks * buckets) >= 999
    small = docs.filter("doc_id < 150")
    got = [sorted(map(tuple, suffix_dedup.remove_repeated_windows(small, **o).drop("text").collect())) for o in ({}, {"block_bytes": 2_000, "bucket_bytes": 3_000})]
    assert got[0] == got[1]


@pytest.mark.parametrize("window", [20, 50, 64, 130])
def test_other_windows(spark, window):
    rng = random.Random(window)
    bits = ["".join(rng.choices("abc ", k=rng.randint(1, window))) for _ in range(12)]
    rows = [(i, "".join(rng.choices(bits, k=6))) for i in range(60)]
    out = suffix_dedup.remove_repeated_windows(spark.createDataFrame(rows, "doc_id bigint, text string"), window=window, block_bytes=3000, bucket_bytes=2000).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out)
    assert got == plain_removal([(d, t.encode()) for d, t in rows], window)
