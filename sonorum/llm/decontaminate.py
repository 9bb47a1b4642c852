"""Benchmark decontamination by BM25 with block-max WAND.

The test items are the indexed collection, and every passage of every training document is a
query. Scores are BM25 with each item's own full score as the unit, so that one threshold fits
items of any length. A passage is two halves, each as long as the item or longer, by powers of two,
so what is found of an item depends on that item alone and not on what else is searched for.

The lists are in order of the items, in blocks of items, with the greatest score of each term in
each block. An item's commonest terms do not drive the search as long as they hold no more than
SLACK of its score: blocks are reached through the lists of the other terms only, and a block whose
maxima, with what the common terms could add, stay below the threshold is skipped. This is done for all
passages of some texts at once. WAND then moves over all lists of a passage's terms, from pivot
to pivot, and past every skipped block. What is found counts where the item's question and its answer are both
there, as word n-grams of the passage, or, for items that are one text, where enough of the whole is
there wherever words are changed or cut.

The index is built from item blocks of a bounded number of words. Further blocks are searched one
after the other, each by a pass of its own, so that no task holds more than one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonorum.llm.common import materialize, read_table

#: ASCII capitals to lower case, ASCII characters that are no letter or digit to space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
#: Items in a block of the lists.
BLOCK = 8
K1, B = 1.2, 0.75
#: Share of an item's full score that its commonest terms hold without driving the search; below any threshold.
SLACK = 0.4
#: Words of half a passage at least.
LEAST_HALF = 64
#: Parts of fewer words are compared by word pairs too.
SHORT = 15
#: Of an item that is one text, this share of the whole is a leak.
WHOLE_SHARE = 0.6
#: Words of texts that are matched together.
WORDS_AT_ONCE = 200_000

Item = tuple[int, list[bytes], list[bytes]]


def fold_words(text: str | bytes | None) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return data.translate(FOLD).split()


def half_passage(words: int) -> int:
    """Words of half a passage for an item of so many."""
    return max(LEAST_HALF, 1 << (words - 1).bit_length())


def _grams(words: list[bytes], n: int) -> set:
    return set(zip(*(words[k:] for k in range(n)), strict=False)) if 0 < n <= len(words) else set()


def _part(words: list[bytes], gram: int) -> list[set]:
    """The n-grams of a part of an item; of a short part the word pairs too, as one changed word spoils fewer of them."""
    own = [_grams(words, min(gram, len(words)))]
    return [*own, _grams(words, 2)] if 2 < gram <= len(words) < SHORT else own


class ItemIndex:
    """Inverted index of items (item_id, question words, answer words) with one length of passage.

    `lists` has places, scores and the greatest score of each term. `starts`, `blocks` and `maxima`
    are the block maxima of the driving terms as flat arrays, and `rest` is what the other terms of a
    block's items hold at most.
    """

    def __init__(self, items: list[Item], terms: dict[bytes, int], df: dict[bytes, int], n_items: int, mean_words: float, gram: int, half: int):
        self.ids = [i for i, _, _ in items]
        self.half = half
        self.n_blocks = (len(items) - 1) // BLOCK + 1
        self.grams = [(_part(q, gram), _part(a, gram), _part(q + a, gram)) for _, q, a in items]
        self.rest = np.zeros(self.n_blocks)
        places: dict[int, list[int]] = defaultdict(list)
        scores: dict[int, list[float]] = defaultdict(list)
        maxima: dict[tuple[int, int], float] = {}
        for place, (_, question, answer) in enumerate(items):
            counts = Counter(question + answer)
            size = sum(counts.values())
            own = {}
            for term, tf in counts.items():
                idf = np.log(1 + (n_items - df[term] + 0.5) / (df[term] + 0.5))
                own[term] = float(idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean_words)))
            full = sum(own.values()) or 1.0
            held, block = 0.0, place // BLOCK
            for term in sorted(own, key=lambda t: (-df[t], t)):
                k, score = terms.setdefault(term, len(terms)), own[term] / full
                places[k].append(place)
                scores[k].append(score)
                held += score
                if held <= SLACK:
                    self.rest[block] = max(self.rest[block], held)
                else:
                    maxima[k, block] = max(maxima.get((k, block), 0.0), score)
        self.lists = {k: (own, scores[k], max(scores[k])) for k, own in places.items()}
        keys = sorted(maxima)
        self.blocks = np.array([block for _, block in keys], np.int64)
        self.maxima = np.array([maxima[key] for key in keys])
        self._terms = np.array([k for k, _ in keys], np.int64)

    def close(self, n_terms: int) -> None:
        """Once all terms have their numbers."""
        self.starts = np.searchsorted(self._terms, np.arange(n_terms + 1))

    def live_blocks(self, halves: np.ndarray, terms: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(passage, block), ascending, where an item can score `threshold`; passage h is of the halves h and h + 1."""
        length = self.starts[terms + 1] - self.starts[terms]
        own = length > 0
        halves, terms, length = halves[own], terms[own], length[own]
        at = np.repeat(self.starts[terms] - np.cumsum(length) + length, length) + np.arange(length.sum())
        keys, most = np.repeat(halves, length) * self.n_blocks + self.blocks[at], self.maxima[at]
        early = keys - self.n_blocks  # the passage before begins with the half before
        keys, most = np.r_[keys, early[early >= 0]], np.r_[most, most[early >= 0]]
        order = np.argsort(keys, kind="stable")
        keys, most = keys[order], most[order]
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        if not len(new):
            return new, new
        keys, bound = keys[new], np.add.reduceat(most, new)
        keys = keys[bound + self.rest[keys % self.n_blocks] >= threshold - 1e-9]
        return keys // self.n_blocks, keys % self.n_blocks

    def search(self, terms: list[int], live: list[int], threshold: float) -> list[tuple[int, float]]:
        """(item place, score) of the items in the live blocks that score at least `threshold` for these distinct terms, by WAND."""
        cursors = []
        for t in terms:
            if (own := self.lists.get(t)) is not None:
                places, scores, most = own
                at = bisect_left(places, live[0] * BLOCK)
                if at < len(places):
                    cursors.append([places[at], at, places, scores, most])
        found, k = [], 0
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, None
            for cursor in cursors:
                bound += cursor[4]
                if bound >= threshold - 1e-9:
                    pivot = cursor[0]
                    break
            if pivot is None:
                break
            k = bisect_left(live, pivot // BLOCK, k)
            if k == len(live):
                break
            target = max(pivot, live[k] * BLOCK)
            if target == cursors[0][0]:
                score = sum(c[3][c[1]] for c in cursors if c[0] == pivot)
                if score >= threshold:
                    found.append((pivot, score))
                target += 1
            moved = []
            for cursor in cursors:
                if cursor[0] < target:
                    at = bisect_left(cursor[2], target, cursor[1])
                    if at == len(cursor[2]):
                        continue
                    cursor[0], cursor[1] = cursor[2][at], at
                moved.append(cursor)
            cursors = moved
        return found


def build_indexes(items: list[Item], df: dict[bytes, int], n_items: int, mean_words: float, gram: int) -> tuple[dict[bytes, int], list[ItemIndex]]:
    """(term -> number, an index for each length of passages)."""
    terms: dict[bytes, int] = {}
    of_half: dict[int, list[Item]] = defaultdict(list)
    for item in items:
        of_half[half_passage(len(item[1]) + len(item[2]))].append(item)
    indexes = [ItemIndex(own, terms, df, n_items, mean_words, gram, half) for half, own in sorted(of_half.items())]
    for index in indexes:
        index.close(len(terms))
    return terms, indexes


def _overlap(part: list[set], words: list[bytes]) -> float:
    return max(len(wanted & _grams(words, len(next(iter(wanted))))) / len(wanted) if wanted else 1.0 for wanted in part)


def find_leaks(texts: list[list[bytes]], terms: dict[bytes, int], indexes: list[ItemIndex], threshold: float, question_share: float, answer_share: float, whole_share: float | None = None) -> list[tuple[int, int, float, float, float, int]]:
    """(place of the text, item_id, score, question overlap, answer overlap, first word of the passage), the best passage of each item.

    A passage starts at every half, so any stretch as long as an item lies whole in one.
    """
    known = []
    for words in texts:
        ids = np.fromiter(map(terms.get, words, repeat(-1)), np.int64, len(words))
        at = np.flatnonzero(ids >= 0)
        known.append((at, ids[at]))
    out = []
    for index in indexes:
        half = index.half
        first = np.cumsum([0, *(len(w) // half + 2 for w in texts)])
        pairs = [(at // half + start) << 32 | ids for (at, ids), start in zip(known, first.tolist(), strict=False)]
        pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        halves, numbers = pairs >> 32, pairs & 0xFFFFFFFF
        passages, blocks = index.live_blocks(halves, numbers, threshold)
        cuts = np.flatnonzero(np.r_[True, passages[1:] != passages[:-1]]) if len(passages) else np.zeros(0, np.int64)
        best: dict[tuple[int, int], tuple[float, float, float, int]] = {}
        for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(passages)], strict=False):
            h = int(passages[begin])
            text = int(np.searchsorted(first, h, "right")) - 1
            at, until = np.searchsorted(halves, (h, h + 2))
            passage, start = None, (h - int(first[text])) * half
            for place, score in index.search(sorted(set(numbers[at:until].tolist())), blocks[begin:end].tolist(), threshold):
                passage = texts[text][start : start + 2 * half] if passage is None else passage
                q, a, whole = (_overlap(part, passage) for part in index.grams[place])
                had = best.get((text, place))
                held = (q >= question_share and a >= answer_share) or (whole_share is not None and whole >= whole_share)
                if held and (had is None or (q + a, score) > (had[1] + had[2], had[0])):
                    best[text, place] = (score, q, a, start)
        out += [(text, index.ids[place], *rest) for (text, place), rest in best.items()]
    return sorted(out)


def _words(text: Column) -> Column:
    """The words of fold_words, as SQL."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(F.regexp_replace(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), " "), lambda w: w != "")


LEAKS = "array<struct<item_id:bigint,score:double,question_overlap:double,answer_overlap:double,passage_start:int>>"
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()), ("passage_start", pa.int32())]))


def _searches(spark: SparkSession, items: DataFrame, threshold: float, question_share: float, answer_share: float, gram: int, max_words: int, whole_share: float | None) -> Iterator[tuple[bool, Callable[[Column], Column]]]:
    """(whether it is the only one, text -> leaks) for each block of items, about `max_words` words; only one block is in use at a time."""
    if not threshold > SLACK:
        raise ValueError(f"the threshold must be above {SLACK}")
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), "question", "answer").withColumn("words", _words(F.concat_ws(" ", "question", "answer"))).filter(F.size("words") > 0)
    n_items, n_words = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
    n_blocks = -(-n_words // max_words)
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "question", "answer"), F.lit(max(1, n_blocks))))
    df = items.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").count()
    if n_blocks > 1:
        df = materialize(df, "terms")
    for block in range(n_blocks):
        own = dealt.filter(F.col("block") == block)
        rows = own.select("item_id", "question", "answer").collect()
        named = own.select(F.explode("words").alias("term")).distinct()
        counts = {r["term"].encode(): r["count"] for r in df.join(named, "term", "left_semi").collect()}
        parts = sorted((r["item_id"] is not None, r["item_id"] or 0, fold_words(r["question"]), fold_words(r["answer"])) for r in rows)
        shared = spark.sparkContext.broadcast(([(i if there else None, q, a) for there, i, q, a in parts], counts, n_items, n_words / n_items, gram))
        search = F.arrow_udf(_searcher(shared, threshold, question_share, answer_share, whole_share), LEAKS)
        yield n_blocks == 1, lambda text, search=search: search(text.cast("binary"))
        if n_blocks > 1:
            shared.unpersist()


def _searcher(shared: Broadcast, threshold: float, question_share: float, answer_share: float, whole_share: float | None):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        terms, indexes = build_indexes(*shared.value)
        for batch in batches:
            found: list[list[tuple]] = [[] for _ in range(len(batch))]
            texts, start, size = [], 0, 0
            for k, text in enumerate(batch):
                texts.append(fold_words(text.as_py()))
                size += len(texts[-1])
                if size >= WORDS_AT_ONCE or k + 1 == len(batch):
                    for at, item, score, q, a, begin in find_leaks(texts, terms, indexes, threshold, question_share, answer_share, whole_share):
                        found[start + at].append({"item_id": item, "score": score, "question_overlap": q, "answer_overlap": a, "passage_start": begin})
                    texts, start, size = [], k + 1, 0
            yield pa.array(found, _ARROW)

    return run


def with_leaks(
    docs: DataFrame,
    items: DataFrame,
    name: str = "leaks",
    threshold: float = 0.6,
    question_share: float = 0.6,
    answer_share: float = 0.6,
    gram: int = 3,
    max_words: int = 500_000,
    whole_share: float | None = None,
) -> DataFrame:
    """docs with one more column: array<struct> of the items in each text, empty where there is none.

    docs: text and any other columns, kept as they are; whole texts are searched, however long, and
    bytes that are no UTF-8 are bytes of a word. items: item_id (an integer), question, answer; a null part is empty and an
    empty part overlaps fully; items without words match nothing. Null, empty and wordless texts
    hold no item; repeated items each match, and so do repeated rows; of equally good passages the
    first is named. An empty table of either gives no leak.
    With `whole_share`, for items that are one text, so much of the whole item counts as well as both parts.
    Items of more than `max_words` words are searched in blocks of about so many, each in a pass over the texts of docs that writes
    only what it finds, by a digest of the text; one join with docs ends it. No block's size or company changes a result.
    """
    key, parts = F.md5(F.col("text").cast("binary")), []
    for only, search in _searches(docs.sparkSession, items, threshold, question_share, answer_share, gram, max_words, whole_share):
        if only:
            return docs.withColumn(name, search(F.col("text")))
        found = docs.select(key.alias("__key"), F.explode(search(F.col("text"))).alias("leak"))
        parts.append(materialize(found.distinct(), "leaks"))
    nothing = F.array().cast(LEAKS)
    if not parts:
        return docs.withColumn(name, nothing)
    found = reduce(DataFrame.unionByName, parts).groupBy("__key").agg(F.array_sort(F.collect_list("leak")).alias("__found"))
    # a text that very many rows repeat is one digest: its finds stand once for each of so many parts of the rows
    copies = 16
    found = found.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    part = F.pmod(F.xxhash64(*(c for c, kind in docs.dtypes if "map<" not in kind)), F.lit(copies)).cast("int")
    joined = docs.withColumn("__key", key).withColumn("__part", part).join(found, ["__key", "__part"], "left")
    return joined.withColumn(name, F.coalesce("__found", nothing)).select(*docs.withColumn(name, nothing).columns)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.6, question_share: float = 0.6, answer_share: float = 0.6, gram: int = 3, max_words: int = 500_000, whole_share: float | None = None) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, passage_start: one row for each document and item in it.

    As with_leaks, but of docs only doc_id and text are read and only what is found is written after each block of items.
    """
    spark = docs.sparkSession
    parts = []
    for only, search in _searches(spark, items, threshold, question_share, answer_share, gram, max_words, whole_share):
        found = docs.select("doc_id", F.explode(search(F.col("text"))).alias("leak")).select("doc_id", "leak.*")
        if only:
            return found
        parts.append(materialize(found, "leaks"))
    out = docs.select("doc_id", F.explode(F.array().cast(LEAKS)).alias("leak")).select("doc_id", "leak.*")
    for part in parts:
        out = part if part is parts[0] else out.unionByName(part)
    return out


def split_items(benchmark: DataFrame, answer_words: int = 8) -> DataFrame:
    """item_id, question, answer of items that are one text: the answer is the last `answer_words` words, half the text at most."""
    words = F.split(F.btrim(F.coalesce("text", F.lit(""))), r"\s+")
    n = F.least(F.lit(answer_words), F.floor(F.size(words) / 2).cast("int"))
    return benchmark.select(
        "item_id",
        F.array_join(F.slice(words, F.lit(1), F.size(words) - n), " ").alias("question"),
        F.array_join(F.slice(words, F.size(words) - n + 1, n), " ").alias("answer"),
    )


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), split_items(read_table(spark, sf_dir, "benchmark")), whole_share=WHOLE_SHARE)
