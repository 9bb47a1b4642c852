"""Toxicity by a classifier chain.

Categories are predicted in a fixed order. Each has a linear model over indicators of words and of
how many different words share a beginning (inflected and joined forms of one stem), scaled by their
log-count ratios, and over the probabilities of the categories before it. In training those
probabilities are out of fold: a row's comes from a model that never saw the row, so the later
models learn from values as they will be in use. The models of one category, one for each fold and
one of all rows, are fitted side by side.
"""

from __future__ import annotations

import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonorum.llm.common import count_partitions, materialize, read_table
from sonorum.llm.linear import dual_coordinate_descent, fit_sigmoid, log_count_ratios, sigmoid

#: ASCII letters to lower case; other ASCII characters that are no letter or digit to space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
#: Bytes of a word's beginning, and how many different words must share it for each indicator.
STARTS, LEVELS = (4, 5, 7), (1, 2, 4)
_CUTS = {n: itemgetter(slice(n)) for n in STARTS}


def _words(text: str | bytes | None) -> set[bytes]:
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return set(data.translate(FOLD).split())


def word_set(text: str | bytes | None) -> set[bytes]:
    """Words, and ``beginning * level`` for beginnings that at least so many different words share."""
    words = _words(text)
    found = set(words)
    for n in STARTS:
        shared = Counter(map(_CUTS[n], words))
        found.update([b"%b*%d" % (start, level) for start, times in shared.items() if len(start) == n for level in LEVELS if times >= level])
    return found


@dataclass
class Link:
    """One category's model: weights of the features, weights of the earlier categories, bias, and the sigmoid."""

    weights: np.ndarray
    earlier: np.ndarray
    bias: float
    slope: float
    shift: float

    def chances(self, margins: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * margins + self.shift)


class Chain:
    """Links over one list of features, of which those without a weight are left out."""

    def __init__(self, names: list[bytes], links: list[Link]):
        used = np.flatnonzero(np.any([link.weights != 0 for link in links], axis=0)) if links and names else np.zeros(0, np.int64)
        self.names = [names[k] for k in used]
        self.links = [Link(link.weights[used] if len(used) else np.zeros(0), link.earlier, link.bias, link.slope, link.shift) for link in links]
        self.weights = np.stack([link.weights for link in self.links], axis=1)
        self.place: dict[bytes, int] = {}
        self.starts: dict[int, dict[bytes, list[tuple[int, int]]]] = {n: defaultdict(list) for n in STARTS}
        for k, name in enumerate(self.names):
            start, star, level = name.partition(b"*")  # no word holds a star
            if star:
                self.starts[len(start)][start].append((int(level), k))
            else:
                self.place[name] = k

    def plain(self) -> tuple[list[bytes], list[tuple]]:
        """Names and links as built-in values and arrays, to be sent to executors."""
        return self.names, [(x.weights, x.earlier, x.bias, x.slope, x.shift) for x in self.links]

    def features(self, text: str | bytes | None) -> list[int]:
        """Numbers of the text's features that have a weight, ascending."""
        words = _words(text)
        found = [self.place[w] for w in words & self.place.keys()]
        for n, own in self.starts.items():
            if own:
                shared = Counter(map(_CUTS[n], words))
                found += [k for start in shared.keys() & own.keys() for level, k in own[start] if shared[start] >= level]
        found.sort()
        return found

    def chances(self, texts: list[str | bytes | None]) -> np.ndarray:
        """A probability for each text and category."""
        rows = [self.features(t) for t in texts]
        out = np.zeros((len(texts), len(self.links)))
        ends = np.cumsum([len(r) for r in rows], dtype=np.int64)
        flat = np.fromiter((k for r in rows for k in r), np.int64, int(ends[-1]) if len(rows) else 0)
        sums = np.concatenate([np.zeros((1, len(self.links))), np.cumsum(self.weights[flat], axis=0)])
        own = sums[ends] - sums[np.r_[0, ends[:-1]]] if len(rows) else out
        for k, link in enumerate(self.links):
            out[:, k] = link.chances(link.bias + own[:, k] + out[:, :k] @ link.earlier)
        return out


def _fit(rows: list[np.ndarray], before: np.ndarray, positive: np.ndarray, size: int, strongest: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature weights, weights of earlier chances, bias); only the features with the strongest ratios count."""
    ratios = log_count_ratios(rows, positive, size)
    if size > strongest:
        ratios[np.argsort(-np.abs(ratios), kind="stable")[strongest:]] = 0.0
    kept = [r[ratios[r] != 0] for r in rows]
    extra = np.arange(size, size + before.shape[1])
    xs = [np.r_[r, extra] for r in kept]
    vs = [np.r_[ratios[r], p] for r, p in zip(kept, before, strict=True)]
    w = dual_coordinate_descent(xs, vs, positive, size + before.shape[1], cost=0.1)
    return w[:size] * ratios, w[size:-1], float(w[-1])


def fit_fold(rows: list[np.ndarray], before: np.ndarray, positive: np.ndarray, folds: np.ndarray, fold: int, size: int, strongest: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, float] | None]:
    """(margins of the rows of `fold` from a model of the other rows, that model); a fold that no row has gives the model of all rows."""
    inside, outside = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
    if not positive[inside].any() or positive[inside].all():
        return np.zeros(len(outside)), None
    w, e, b = _fit([rows[i] for i in inside], before[inside], positive[inside], size, strongest)
    return np.array([w[rows[i]].sum() + before[i] @ e + b for i in outside]), (w, e, b)


def _fold_fitter(category: int, chances: np.ndarray | None, n_folds: int, size: int, strongest: int):
    """Table of all rows (model, doc_id, words, y, fold) -> (model, fitted); model k leaves fold k out, model n_folds none. chances: of the earlier categories, rows in their one order."""

    def fit(table: pa.Table) -> pa.Table:
        fold = table.column("model")[0].as_py()
        words = table.column("words").combine_chunks()
        ends, numbers = words.offsets.to_numpy(), words.values.to_numpy()
        rows = [numbers[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        ids, y, of_row = (table.column(c).to_pylist() for c in ("doc_id", "y", "fold"))
        order = sorted(range(len(ids)), key=lambda i: (ids[i], y[i], of_row[i], rows[i].tobytes()))
        rows, folds = [rows[i] for i in order], np.array([of_row[i] for i in order])
        positive = np.array([y[i][category] for i in order], bool)
        margins, model = fit_fold(rows, np.zeros((len(rows), 0)) if chances is None else chances, positive, folds, fold, size, strongest)
        whole = fold == n_folds
        packed = pickle.dumps((np.flatnonzero(folds == fold), margins, model if whole else None, positive if whole else None))
        return pa.table({"model": pa.array([fold], pa.int32()), "fitted": pa.array([packed], pa.binary())})

    return fit


def finish_link(margins: np.ndarray, positive: np.ndarray, model: tuple[np.ndarray, np.ndarray, float] | None, size: int, earlier: int) -> Link:
    """The link of a category from its out-of-fold margins and the model of all rows; without both classes it says what all rows say."""
    if model is None:
        return Link(np.zeros(size), np.zeros(earlier), 0.0, 0.0, 40.0 if len(positive) and positive.all() else -40.0)
    slope, shift = fit_sigmoid(margins, positive)
    return Link(*model, slope, shift)


def train_chain(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str], max_docs: int = 8_000, n_folds: int = 4, min_docs: int = 3, max_features: int = 200_000, strongest: int = 20_000, seed: int = 13
) -> Chain:
    """categories: name -> boolean SQL over the columns of labels, in chain order.

    About `max_docs` labelled documents are learned from, chosen by a hash of doc_id, with the
    features that at least `min_docs` of them have, the `max_features` commonest at most. Their numbers are all that a
    fitting task is given. Rows with a null id or category do not count.
    """
    spark = docs.sparkSession
    known = labels.select("doc_id", F.array(*[F.expr(c).cast("int") for c in categories.values()]).alias("y")).filter("doc_id is not null and not exists(y, v -> v is null)").distinct()
    n = known.count()
    h = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 20))
    chosen = known.filter(h < min(1.0, max_docs / max(n, 1)) * (1 << 20)).withColumn("fold", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(n_folds)).cast("int"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pa.array([list(word_set(t.as_py())) for t in batch.column(1)], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), words, batch.column(2), batch.column(3)], ["doc_id", "words", "y", "fold"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y", "fold")
    rows = rows.repartition(count_partitions(spark))  # few rows of much work
    sample = materialize(rows.mapInArrow(extract, f"doc_id {ids}, words array<binary>, y array<int>, fold int"), "sample")
    common = sample.select(F.explode("words").alias("word")).groupBy("word").count().filter(F.col("count") >= min_docs)
    names = sorted(bytes(r["word"]) for r in common.orderBy(F.desc("count"), "word").limit(max_features).collect())
    shared = spark.sparkContext.broadcast(names)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: k for k, w in enumerate(shared.value)}
        for batch in batches:
            found = pa.array([sorted(place[w] for w in row if w in place) for row in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), found, batch.column(2), batch.column(3)], ["doc_id", "words", "y", "fold"])

    numbered = materialize(sample.mapInArrow(number, f"doc_id {ids}, words array<int>, y array<int>, fold int"), "numbered")
    tasks = numbered.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(n_folds)))).repartition(4 * (n_folds + 1), "model")
    size, links, chances = len(names), [], None
    for category in range(len(categories)):
        fit = _fold_fitter(category, chances, n_folds, size, strongest)
        found = {r["model"]: pickle.loads(r["fitted"]) for r in tasks.groupBy("model").applyInArrow(fit, "model int, fitted binary").collect()}
        if not found:  # no labelled row
            return Chain([], [Link(np.zeros(0), np.zeros(k), 0.0, 0.0, -40.0) for k in range(len(categories))])
        _, _, model, positive = found[n_folds]
        margins = np.zeros(len(positive))
        for fold in range(n_folds):
            at, own, _, _ = found[fold]
            margins[at] = own
        links.append(finish_link(margins, positive, model, size, category))
        column = links[-1].chances(margins)[:, None]
        chances = column if chances is None else np.concatenate([chances, column], axis=1)
    return Chain(names, links)


def chain_scores(text: Column, chain: Chain, names: list[str], spark: SparkSession) -> Column:
    """struct of a probability for each category. The model has at most `strongest` features for each."""
    shared = spark.sparkContext.broadcast(chain.plain())

    @F.arrow_udf(", ".join(f"`{n}` double" for n in names))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, links = shared.value
        model = Chain(known, [Link(*x) for x in links])
        for texts in batches:
            found = np.concatenate([np.zeros((0, len(names))), *(model.chances(texts[k : k + 1024].to_pylist()) for k in range(0, len(texts), 1024))])
            yield pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(len(names))], names)

    return run(text.cast("binary"))


def classify_toxicity(docs: DataFrame, labels: DataFrame, categories: dict[str, str], keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.5) -> DataFrame:
    """`keep`, a probability p_<category> for each category, and toxic: the last category's is at least `threshold`.

    Whole texts are scored, however long; bytes that are no UTF-8 are bytes of a word. Null, empty
    and wordless texts are scored by the biases alone. Equal texts have equal scores, and a score at the
    threshold is toxic. Repeated rows stay repeated; a doc_id with two different labels is learned
    with both; other columns are not read. Without labels every probability is 0 and nothing is
    toxic; an empty table gives no rows.
    """
    spark = docs.sparkSession
    chain = train_chain(docs, labels, categories)
    names = [f"p_{c}" for c in categories]
    scored = docs.withColumn("__p", chain_scores(F.col("text"), chain, names, spark)).select(*keep, "__p.*")
    return scored.withColumn("toxic", F.col(names[-1]) >= threshold)


#: The chain of the registered query: junk first, as its probability tells the toxic model how far to trust words.
QUERY_CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), QUERY_CATEGORIES)
