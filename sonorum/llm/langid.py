"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram's vector binds (multiplies) its letters'
vectors, permuted (rotated) by their place; a text's vector bundles (adds) the vectors of its
trigrams, and a language's prototype bundles its documents. A text has the language whose
prototype has the greatest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonorum.llm.common import is_held_out, read_table

UNKNOWN = "und"
_SCALE = 1 << 20
#: Trigrams that are bound and bundled at once.
AT_ONCE = 4096


class Profiler:
    """Texts to hypervectors. Every letter, of whatever script, has its own seeded vector; 0 is no letter."""

    def __init__(self, dims: int, seed: int):
        self.dims, self.seed, self.size, self.bits = dims, seed, 0, 10
        self.numbers = np.full(0x110000, -1, np.int32)  # code point -> symbol; -1: not met yet
        self.places = [np.zeros((256, dims), np.int8) for _ in range(3)]
        self._add([0])

    def _add(self, points: list[int]) -> None:
        """Numbers and vectors of code points that are met for the first time; a vector depends on seed and code point alone."""
        letters = [c for c in points if c == 0 or chr(c).isalpha()]
        self.numbers[points] = 0
        self.numbers[letters] = self.size + np.arange(len(letters))
        if self.size + len(letters) > len(self.places[0]):
            more = np.zeros((self.size + len(letters), self.dims), np.int8)
            self.places = [np.concatenate([own, more]) for own in self.places]
        for letter in letters:
            vector = np.random.default_rng((self.seed, letter)).integers(0, 2, self.dims, np.int8) * 2 - 1
            for k, own in enumerate(self.places):
                own[self.size] = np.roll(vector, 2 - k)
            self.size += 1

    def trigrams(self, text: str | bytes) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams around each letter as numbers (`bits` bits a letter), with counts; what stands beside a word is symbol 0.

        Bytes that are no UTF-8 are no letters.
        """
        said = text.decode("utf-8", "replace") if isinstance(text, bytes) else text
        points = np.frombuffer(said.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        codes = self.numbers[points]
        if len(codes) and codes.min() < 0:
            self._add(np.unique(points[codes < 0]).tolist())
            codes = self.numbers[points]
        self.bits = 10 if self.size <= 1024 else 21
        codes = np.concatenate(([0], codes, [0])).astype(np.int32 if self.bits == 10 else np.int64)
        found = (codes[:-2] << 2 * self.bits | codes[1:-1] << self.bits | codes[2:])[codes[1:-1] > 0]
        found.sort()
        starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.zeros(0, np.int64)
        return found[starts], np.diff(np.r_[starts, len(found)])

    def vector(self, text: str | bytes | None) -> np.ndarray | None:
        """Unit vector of the text, or None where it has no letter."""
        grams, counts = self.trigrams(text or "")
        if not len(grams):
            return None
        total, low = np.zeros(self.dims, np.float32), (1 << self.bits) - 1
        for k in range(0, len(grams), AT_ONCE):
            g = grams[k : k + AT_ONCE]
            bound = self.places[0][g >> 2 * self.bits] * self.places[1][g >> self.bits & low] * self.places[2][g & low]
            total += counts[k : k + AT_ONCE].astype(np.float32) @ bound.astype(np.float32)
        norm = float(np.sqrt(total @ total))
        return total / norm if norm else total


def train_profiles(labelled: DataFrame, dims: int = 1024, seed: int = 11, max_docs: int = 4000, lang_col: str = "lang") -> dict[str, list[float]]:
    """language -> unit prototype, from doc_id, text and lang.

    About `max_docs` documents of each language are read, chosen by a hash of doc_id; rows without
    lang and texts without letters do not count. The driver gets a count and one vector for each
    language, so lang must be a code of few values.
    """
    labelled = labelled.filter(F.col(lang_col).isNotNull())
    seen = labelled.groupBy(F.col(lang_col).cast("string").alias("lang")).count().collect()
    if not seen:
        return {}
    portions = F.create_map(*[F.lit(x) for row in seen for x in (row["lang"], min(1.0, max_docs / row["count"]))])
    chosen = labelled.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 20)) < F.element_at(portions, F.col(lang_col).cast("string")) * (1 << 20))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = Profiler(dims, seed)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (v := profiler.vector(text)) is not None:
                    own = sums.setdefault(lang, np.zeros(dims, np.int64))
                    own += np.round(v * _SCALE).astype(np.int64)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dims), pa.array(range(dims), pa.int32()), pa.array(total)], ["lang", "dim", "total"])

    parts = chosen.select(F.col(lang_col).cast("string").alias("lang"), F.col("text").cast("binary").alias("text")).mapInArrow(bundle, "lang string, dim int, total bigint")
    sums: dict[str, np.ndarray] = {}
    for row in parts.groupBy("lang", "dim").agg(F.sum("total").alias("total")).collect():
        sums.setdefault(row["lang"], np.zeros(dims))[row["dim"]] = row["total"]
    return {lang: (v / max(np.linalg.norm(v), 1e-12)).tolist() for lang, v in sorted(sums.items())}


def predict_language(text: Column, profiles: dict[str, list[float]], dims: int = 1024, seed: int = 11) -> Column:
    """struct<lang_pred, score>: the nearest prototype and its cosine, at least 0; `und` and 0 for null and texts without a letter.

    Ties go to the language first in order of its name; without profiles every text is `und`.
    """
    names = sorted(profiles)
    matrix = np.array([profiles[n] for n in names], np.float32).reshape(-1, dims)

    @F.arrow_udf("lang_pred string, score double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        profiler = Profiler(dims, seed)
        for texts in batches:
            langs, scores = [], []
            for text in texts:
                v = profiler.vector(text.as_py()) if names else None
                if v is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                else:
                    cosines = matrix @ v
                    best = int(np.argmax(cosines))
                    langs.append(names[best])
                    scores.append(min(1.0, max(0.0, float(cosines[best]))))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return run(text.cast("binary"))


def identify_languages(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep`, held_out, lang_pred, score for each row of docs (doc_id, text, lang).

    Profiles come from the rows that are not held out and have a lang. Whole texts are read, however
    long. Null, empty and letterless texts are `und` with score 0; of languages as near the first by
    name is taken; repeated rows stay repeated and count in a profile each; an empty table gives no rows; other columns are not read.
    """
    profiles = train_profiles(docs.filter(~is_held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    found = docs.withColumn("__found", predict_language(F.col("text"), profiles))
    return found.select(*keep, is_held_out(F.col("doc_id")).alias("held_out"), "__found.lang_pred", "__found.score")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read_table(spark, sf_dir, "documents"))
