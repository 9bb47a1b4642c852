"""Alignment of the tokens of two tokenizers over the same bytes.

Both tokenizers' tokens are laid out as byte ranges of the same text. Offsets where a token of each ends cut
a text into groups, and the last tokens of a group, whose ranges end together, are a link. Most groups are one token of A and the
token of B that has the same bytes. An array from A's ids to B's gives that token, so such links are counted in
a vector as long as the vocabulary; only the links of other groups are counted by a shuffle of pairs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonorum.llm.common import materialize, read_table

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A space between letters, before which no token of either kind goes on: pieces start with their space.
CUT = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")
#: Characters of a text, and of a batch of texts, that are encoded at once, and rows that go on at once.
CHUNK, BATCH, ROWS = 100_000, 400_000, 500
LONG_RUN = 5_000
LONG_SPACE = re.compile(r"\s{%d}" % LONG_RUN)
#: How byte-level vocabularies of this kind cut texts before merging. Fixed value: it comes with the tokenizer.
BYTE_LEVEL = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_char() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@dataclass
class Tokenizers:
    """The contents of the two files, and what is made of them when it is first used."""

    a_json: str
    b_model: bytes

    @classmethod
    def read(cls, folder: str = TOKENIZERS, a_file: str = A_FILE, b_file: str = B_FILE) -> Tokenizers:
        with open(f"{folder}/{a_file}", encoding="utf-8") as a, open(f"{folder}/{b_file}", "rb") as b:
            return cls(a.read(), b.read())

    def shared(self, spark: SparkSession) -> Callable[[], Tokenizers]:
        """A function that gives these tokenizers in a task. Each Python worker makes what it needs of the files, a few MB, once."""
        held = spark.sparkContext.broadcast({"files": (self.a_json, self.b_model)})
        return lambda: held.value.get("own") or held.value.setdefault("own", Tokenizers(*held.value["files"]))

    @cached_property
    def a_vocabulary(self) -> dict[bytes, int]:
        """Ids by bytes, special tokens left out."""
        chars = byte_of_char()
        return {bytes(map(chars.__getitem__, token)): i for token, i in json.loads(self.a_json)["model"]["vocab"].items()}

    @cached_property
    def a(self) -> Callable[[str], list[int]]:
        """The encoder of A. Where ids are in the order of the merges, as ranks are, tiktoken gives the same tokens four times faster.

        Texts with very long runs of white space, over which its pattern can't go, are left to the file's own library.
        """

        def by_file(text: str) -> list[int]:
            return self.a_tokenizer.encode(text, add_special_tokens=False).ids

        model = json.loads(self.a_json)
        chars = byte_of_char()
        merges = (m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in model["model"]["merges"])
        ranked = [self.a_vocabulary.get(bytes(map(chars.__getitem__, m))) for m in merges]
        plain = model["normalizer"] is None and model["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        if plain and None not in ranked and all(x < y for x, y in zip(ranked, ranked[1:], strict=False)):
            from tiktoken import Encoding

            fast = Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=self.a_vocabulary, special_tokens={}).encode_ordinary
            return lambda text: by_file(text) if len(text) > LONG_RUN and LONG_SPACE.search(text) else fast(text)
        return by_file

    @cached_property
    def a_tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        found = Tokenizer.from_str(self.a_json)
        found.encode_special_tokens = True
        return found

    @cached_property
    def b(self):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self.b_model)

    @cached_property
    def a_bytes(self) -> list[bytes]:
        found = {i: token for token, i in self.a_vocabulary.items()}
        return [found.get(i, b"") for i in range(max(found) + 1)]

    @cached_property
    def b_bytes(self) -> list[bytes]:
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        return [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    @cached_property
    def identity(self) -> np.ndarray:
        """B's id with the bytes of each id of A, or -1; of several the least that is no single-byte token."""
        plain = [i for i in range(len(self.b_bytes)) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        of_bytes: dict[bytes, int] = {}
        for i in [*plain, *filter(self.b.is_byte, range(len(self.b_bytes)))]:
            of_bytes.setdefault(self.b_bytes[i], i)
        return np.array([of_bytes.get(t, -1) for t in self.a_bytes], np.int64)

    @cached_property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(list(map(len, self.a_bytes))), np.array(list(map(len, self.b_bytes)))

    @cached_property
    def names(self) -> dict[str, np.ndarray]:
        """Ids in decimal with the sign that follows them."""
        return {sign + side: np.array([b"%d%s" % (i, sign.encode()) for i in range(len(own))], object) for side, own, signs in (("a", self.a_bytes, ",|"), ("b", self.b_bytes, ",;")) for sign in signs}


def chunks(text: str, size: int = CHUNK) -> list[str]:
    """text without the spaces at which it is cut; the tokens of the parts, each after a space, are those of the whole."""
    parts, start = [], 0
    while len(text) - start > size and (cut := CUT.search(text, start + size)):
        parts.append(text[start : cut.start()])
        start = cut.end()
    return [*parts, text[start:]]


def encode(own: Tokenizers, texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of A and B of each text in order; none where text is null, empty, or not what the tokens' bytes join to."""
    nothing = np.zeros(0, np.int64)

    def encoded(batch: list[tuple[bytes, list[str]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        flat = [part for _, parts in batch for part in parts]
        a_parts = [own.a(f" {part}") for part in flat]
        b_parts = own.b.encode(flat, num_threads=1) if flat else []
        at = 0
        for data, parts in batch:
            a = [i for ids in a_parts[at : at + len(parts)] for i in ids]
            b = [i for ids in b_parts[at : at + len(parts)] for i in ids]
            at += len(parts)
            whole = b" " + data
            fits = parts and b"".join(map(own.a_bytes.__getitem__, a)) == whole and b"".join(map(own.b_bytes.__getitem__, b)) == whole
            yield (np.array(a, np.int64), np.array(b, np.int64)) if fits else (nothing, nothing)

    batch, held = [], 0
    for data in texts:
        try:
            text = (data or b"").decode()
        except UnicodeDecodeError:
            text = ""
        batch.append((data or b"", chunks(text) if text else []))
        held += len(text)
        if held >= BATCH or len(batch) >= 1000:
            yield from encoded(batch)
            batch, held = [], 0
    yield from encoded(batch)


def groups(own: Tokenizers, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group how many tokens of A, and of B, there are up to its end."""
    ends_a, ends_b = np.cumsum(own.sizes[0][a]), np.cumsum(own.sizes[1][b])
    at = np.searchsorted(ends_b, ends_a)
    shared = at < len(ends_b)
    shared[shared] = ends_b[at[shared]] == ends_a[shared]
    return np.flatnonzero(shared) + 1, at[shared] + 1


def groups_digest(own: Tokenizers, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> str:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
    if not len(a_ends):
        return ""
    tokens_a, tokens_b = own.names[",a"][a], own.names[",b"][b]
    tokens_a[a_ends - 1], tokens_b[b_ends - 1] = own.names["|a"][a[a_ends - 1]], own.names[";b"][b[b_ends - 1]]
    out = np.empty(len(a) + len(b), object)
    # a token stands behind those of its own kind before it and those of the other kind in the groups before it (A) or to its own group's end (B)
    out[np.arange(len(a)) + np.repeat(np.r_[0, b_ends[:-1]], np.diff(a_ends, prepend=0))] = tokens_a
    out[np.arange(len(b)) + np.repeat(a_ends, np.diff(b_ends, prepend=0))] = tokens_b
    return hashlib.sha256(b"".join(out.tolist())[:-1]).hexdigest()


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *arrays]), kind))


def align(docs: DataFrame, tokenizers: Tokenizers, tokens: bool = True, links: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_a, n_b, n_groups, groups_sha256; with `tokens` a_ids, b_ids, a_ends, b_ends; with `links` regular, irregular.

    Group k has the tokens from a_ends[k - 1] to a_ends[k] of A and from b_ends[k - 1] to b_ends[k] of B. regular
    has A's ids of the groups of one token each whose B token is the identity map's, irregular `a << 32 | b` of the other
    links. Null and empty texts, bytes that are no UTF-8 and texts that the tokens' bytes do not join to have no tokens.
    Texts may have any length: they are encoded in parts, cut where no token can go on. Repeated rows
    stay repeated, null ids are ids, an empty table stays empty, and extra columns of docs are not read.
    """
    shared = tokenizers.shared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared()
        for batch in (whole.slice(k, ROWS) for whole in batches for k in range(0, whole.num_rows, ROWS)):
            texts = (t.as_py() for t in batch.column(1))
            rows, arrays = [], []
            for a, b in encode(own, texts):
                a_ends, b_ends = groups(own, a, b)
                rows.append((len(a), len(b), len(a_ends), groups_digest(own, a, b, a_ends, b_ends)))
                if links:
                    last_a, last_b = a[a_ends - 1], b[b_ends - 1]
                    # tokens with the same bytes that end together begin together, so they are a group of their own
                    same = own.identity[last_a] == last_b
                    found = [last_a[same], last_a[~same] << 32 | last_b[~same]]
                arrays.append(([a, b, a_ends, b_ends] if tokens else []) + (found if links else []))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            kinds = [pa.int32()] * (4 * tokens) + [pa.int32(), pa.int64()] * links
            lists = [_lists([r[k] for r in arrays], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *lists], names)

    more = [f"{c} array<int>" for c in ("a_ids", "b_ids", "a_ends", "b_ends")] * tokens + ["regular array<int>", "irregular array<bigint>"] * links
    schema = ", ".join([f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string", *more])
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)


def pair_counts(linked: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """a, b, n, best: how many links hold each pair of ids, and whether no other pair of its b has more. linked: regular, irregular of align().

    A task adds its regular links up in one vector and its irregular ones in runs of equal pairs before anything is shuffled.
    """
    identity = tokenizers.identity

    def one_to_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(identity), np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=len(total))
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(identity[there], pa.int32()), pa.array(total[there])], ["a", "b", "n"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, n = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs >> 32, pa.int32()), pa.array(pairs & 0xFFFFFFFF, pa.int32()), pa.array(n, pa.int64())], ["a", "b", "n"])

    kind = "a int, b int, n bigint"
    counted = linked.select("regular").mapInArrow(one_to_one, kind).groupBy("a", "b").agg(F.sum("n").alias("n"))
    shuffled = linked.select("irregular").mapInArrow(others, kind).groupBy("a", "b").agg(F.sum("n").alias("n"))
    pairs = materialize(counted.unionByName(shuffled), "pairs")
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))
    return pairs.join(F.broadcast(most), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))  # a row for each id of B at most


def link_sums(linked: DataFrame, pairs: DataFrame, tokenizers: Tokenizers, frequent: int = 100_000) -> DataFrame:
    """linked without its arrays, with n_best and count_sum over a row's links. pairs: pair_counts().

    The pairs of the identity map, one for each id of A at most, go to every task as vectors, and so do the other pairs that hold at least one in
    `frequent` of their links, which are `frequent` at most. Links of the rest are joined by pair; no
    pair among them holds more than one in `frequent` of the links. No column of linked may be named row or rest.
    """
    spark = linked.sparkSession
    identity = tokenizers.identity
    pair = F.shiftleft(F.col("a").cast("bigint"), 32).bitwiseOR(F.col("b").cast("bigint"))
    of_b = spark.createDataFrame(pa.table({"a": pa.array(np.arange(len(identity)), pa.int32()), "identity": pa.array(identity, pa.int32())}))
    known = pairs.join(F.broadcast(of_b), "a", "left").select("a", pair.alias("pair"), "n", "best", (F.col("b") == F.col("identity")).alias("regular"))
    known = materialize(known, "counts")
    one = known.filter("regular").select("a", "n", "best").toArrow()
    n_of_a, best_of_a = np.zeros(len(identity), np.int64), np.zeros(len(identity), np.int64)
    n_of_a[one.column("a").to_numpy()], best_of_a[one.column("a").to_numpy()] = one.column("n").to_numpy(), one.column("best").to_numpy().astype(np.int64)
    others = known.filter("not regular")
    total = others.agg(F.sum("n")).first()[0] or 0
    top = others.filter(F.col("n") * frequent >= total).select("pair", "n", "best").toArrow().sort_by("pair")
    tables = spark.sparkContext.broadcast((n_of_a, best_of_a, *(top.column(c).to_numpy().astype(np.int64) for c in ("pair", "n", "best"))))
    kept = [c for c in linked.columns if c not in ("regular", "irregular")]

    def row_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(values)][ends])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_of_a, best_of_a, keys, n, best = tables.value
        keys, n, best = np.r_[keys, np.iinfo(np.int64).max], np.r_[n, 0], np.r_[best, 0]
        for batch in batches:
            a, pairs = batch.column("regular"), batch.column("irregular")
            ids, values, ends = a.flatten().to_numpy(), pairs.flatten().to_numpy(), pairs.offsets.to_numpy() - pairs.offsets[0].as_py()
            a_ends = a.offsets.to_numpy() - a.offsets[0].as_py()
            at = np.searchsorted(keys, values)
            there = keys[at] == values
            sums, bests = (row_sums(x[ids], a_ends) + row_sums(np.where(there, y[at], 0), ends) for x, y in ((n_of_a, n), (best_of_a, best)))
            missing = row_sums((~there).astype(np.int64), ends)
            rest = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(missing)], pa.int32()), pa.array(values[~there]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), batch.column("row"), pa.array(bests), pa.array(sums), rest], [*kept, "row", "n_best", "count_sum", "rest"])

    kinds = "".join(f"`{c}` {linked.schema[c].dataType.simpleString()}, " for c in kept)
    numbered = linked.withColumn("row", F.monotonically_increasing_id())
    summed = materialize(numbered.mapInArrow(run, f"{kinds}row bigint, n_best bigint, count_sum bigint, rest array<bigint>"), "sums")
    rare = summed.select("row", F.explode("rest").alias("pair")).join(others.filter(F.col("n") * frequent < total), "pair")
    more = rare.groupBy("row").agg(F.sum("n").alias("more_n"), F.sum(F.col("best").cast("bigint")).alias("more_best"))
    found = summed.drop("rest").join(more, "row", "left")
    return found.select(*kept, *((F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more_n"))))


def op13_token_alignment(spark: SparkSession, sf_dir: str, folder: str = TOKENIZERS) -> DataFrame:
    tokenizers = Tokenizers.read(folder)
    linked = materialize(align(read_table(spark, sf_dir, "documents"), tokenizers, tokens=False, links=True), "linked")
    summed = link_sums(linked, pair_counts(linked, tokenizers), tokenizers)
    return summed.select(F.col("doc_id").cast("bigint").alias("doc_id"), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
