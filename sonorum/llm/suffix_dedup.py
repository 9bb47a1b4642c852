"""Repeated windows of bytes by a depth-limited radix sort of suffixes.

Suffixes are ordered only through the first `window` bytes, most significant digit first; suffixes
that are equal so far stay together, a group of one is done, and what is still together after the
last digit is exactly a repeated window.

Sending every suffix through a shuffle would cost many times the input, so the first digit is not
the first byte but an anchor: of the short strings inside a window, the one with the least hash.
Equal windows have equal anchors at equal offsets, and one anchor serves many neighbouring windows.

1. Documents are dealt to blocks. A block reports its distinct anchors to buckets of anchor hashes.
2. A bucket tells each block which of its anchors occur in another document.
3. A block sends the windows around those anchors, equal ones once with their least document.
4. A bucket sorts them by the remaining digits and answers, for each window, the least document.
5. A block removes the bytes of windows whose least document comes before their own.

A block speaks once about equal things however often it holds them, so a passage of very many
documents costs a bucket one row for each block. An anchor in more than `hot_blocks` blocks is
spread over buckets by the content of its windows.

Messages are blocks times buckets, so both grow with the root of the input: a message keeps about
`LEAST_MESSAGE` anchors at least, and there is one for so many bytes of input at any size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonorum.llm.common import read_table

U = np.uint64
#: Odd constants of the hashes.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], U)
#: A null doc_id comes after all others.
NO_ID = np.iinfo(np.int64).max
CHUNK = 1 << 20
#: Anchors that a block tells a bucket on average, at least, and bytes of text for each anchor.
LEAST_MESSAGE, ANCHOR_BYTES = 1000, 16
#: Columns of the result besides those kept.
RESULTS = ("doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@dataclass(frozen=True)
class Shape:
    """window bytes; anchor bytes; bits of an anchor's hash; number of buckets."""

    window: int
    anchor: int
    bits: int
    buckets: int

    @property
    def offsets(self) -> int:
        return self.window - self.anchor + 1

    @property
    def width(self) -> int:
        """Bytes of the longest run of windows with one anchor, up to a multiple of 8."""
        return -(-(self.window + self.offsets - 1) // 8) * 8


def _words(buffer: np.ndarray, n: int) -> np.ndarray:
    """The 8 bytes from each of the first n places, as numbers."""
    return np.ndarray((n,), "<u8", buffer, 0, (1,)).astype(U)


def _stir(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> U(29)
    x = x * MIX[1]
    return x ^ x >> U(32)


@dataclass
class Anchors:
    """Runs of windows with one anchor: their first window, how many, the anchor's place in them, its hash, and the text."""

    start: np.ndarray
    windows: np.ndarray
    offset: np.ndarray
    hash: np.ndarray
    text: np.ndarray


def find_anchors(buffer: np.ndarray, ends: np.ndarray, shape: Shape) -> Anchors:
    """buffer: texts one after the other and `width` + 8 spare bytes; ends: where each text ends."""
    total = int(ends[-1]) if len(ends) else 0
    begins = np.r_[0, ends[:-1]].astype(np.int64)
    lengths = ends - begins
    valid = np.repeat(ends, lengths) - np.arange(total) >= shape.window
    if not valid.any():
        empty = np.zeros(0, np.int64)
        return Anchors(empty, empty, empty, empty.astype(U), empty)
    n = total + shape.offsets
    eight = _words(buffer, n + shape.anchor)
    parts = [*range(0, shape.anchor - 8, 8), shape.anchor - 8]
    mixed = np.zeros(n, U)
    for k, at in enumerate(parts):
        mixed += eight[at : at + n] * MIX[k % len(MIX)]
        mixed ^= mixed >> U(31)
    mixed *= MIX[0]
    least = mixed >> U(32) << U(32) | np.arange(n, dtype=U)
    size = 1
    while size * 2 <= shape.offsets:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if shape.offsets > size:
        rest = shape.offsets - size
        least = np.minimum(least[:-rest], least[rest:])
    at = np.flatnonzero(valid)
    place = (least[at] & U(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    start, place = at[new], place[new]
    windows = np.diff(np.r_[new, len(at)])
    return Anchors(start, windows, place - start, _stir(mixed[place] + MIX[3]) >> U(64 - shape.bits), np.searchsorted(ends, start, "right"))


def chunks(texts: list[bytes], shape: Shape) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the first text, buffer, ends), about CHUNK bytes at a time."""
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK or k + 1 == len(texts):
            own = texts[first : k + 1]
            yield first, np.frombuffer(b"".join(own) + bytes(shape.width + 2 * shape.window + 16), np.uint8), np.cumsum([len(t) for t in own])
            first, size = k + 1, 0


def pack(ascending: np.ndarray) -> bytes:
    """Ascending numbers as byte planes of their differences, without the planes that are zero."""
    steps = np.diff(ascending.astype(U), prepend=U(0)).astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 8).T
    used = 8
    while used > 1 and not planes[used - 1].any():
        used -= 1
    return bytes([used]) + planes[:used].tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, : data[0]] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=U)


def squeeze(array: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(array).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unsqueeze(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True), dtype)


def _bucket(hashes: np.ndarray, shape: Shape) -> np.ndarray:
    """Ascending in the hash."""
    top = hashes >> U(max(0, shape.bits - 32))
    return (top * U(shape.buckets) >> U(min(32, shape.bits))).astype(np.int64)


def _slices(sorted_buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    if not len(sorted_buckets):
        return
    cuts = np.flatnonzero(np.r_[True, sorted_buckets[1:] != sorted_buckets[:-1]])
    for begin, end in zip(cuts, [*cuts[1:], len(sorted_buckets)], strict=True):
        yield int(sorted_buckets[begin]), slice(int(begin), int(end))


def _texts(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    ids = table.column("doc_id").fill_null(NO_ID).to_numpy().astype(np.int64)
    return ids, [b"" if t is None else t for t in table.column("text").to_pylist()]


def report_anchors(table: pa.Table, shape: Shape) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed hash * 2 + whether two documents of the block have it)."""
    ids, texts = _texts(table)
    hashes, docs = [], []
    for first, buffer, ends in chunks(texts, shape):
        found = find_anchors(buffer, ends, shape)
        hashes.append(found.hash)
        docs.append(ids[found.text + first])
    if not hashes:
        return
    h, d = np.concatenate(hashes), np.concatenate(docs)
    order = np.argsort(h, kind="stable")
    h, d = h[order], d[order]
    starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    if not len(starts):
        return
    several = np.minimum.reduceat(d, starts) != np.maximum.reduceat(d, starts)
    h = h[starts]
    for bucket, s in _slices(_bucket(h, shape)):
        yield bucket, pack(h[s] << U(1) | several[s].astype(U))


def repeated_anchors(blocks: list[int], payloads: list[bytes], hot_blocks: int) -> Iterator[tuple[int, bytes]]:
    """(block, packed hash * 2 + hot) of the anchors that two documents have."""
    got = [unpack(p) for p in payloads]
    values = np.concatenate(got)
    owner = np.repeat(np.arange(len(got)), [len(g) for g in got])
    h = values >> U(1)
    order = np.argsort(h, kind="stable")
    h, owner, several = h[order], owner[order], (values[order] & U(1)).astype(bool)
    starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    counts = np.diff(np.r_[starts, len(h)])
    repeated = np.repeat((counts > 1) | np.logical_or.reduceat(several, starts), counts)
    hot = np.repeat(counts > hot_blocks, counts)
    h, owner = (h << U(1) | hot.astype(U))[repeated], owner[repeated]
    order = np.argsort(owner, kind="stable")
    for k, s in _slices(owner[order]):
        yield blocks[k], pack(h[order][s])


@dataclass
class Runs:
    """A block's runs of windows around repeated anchors, equal ones once, in order of route, hash and content.

    content: rows of `width` bytes, zero beyond the run; least: least doc_id. For each run in the
    texts: entry (its row), text and start.
    """

    route: np.ndarray
    hash: np.ndarray
    offset: np.ndarray
    windows: np.ndarray
    content: np.ndarray
    least: np.ndarray
    entry: np.ndarray
    text: np.ndarray
    start: np.ndarray


def gather_runs(ids: np.ndarray, texts: list[bytes], wanted: np.ndarray, shape: Shape) -> Runs:
    """wanted: ascending hash * 2 + hot."""
    names, hot = wanted >> U(1), (wanted & U(1)).astype(bool)
    parts = []
    for first, buffer, ends in chunks(texts, shape):
        a = find_anchors(buffer, ends, shape)
        if not len(a.hash) or not len(names):
            continue
        at = np.minimum(np.searchsorted(names, a.hash), len(names) - 1)
        own = np.flatnonzero(names[at] == a.hash)
        start, windows, offset, is_hot = a.start[own], a.windows[own], a.offset[own], hot[at[own]]
        h, text = a.hash[own], a.text[own]
        if is_hot.any():  # each window of a hot anchor by itself
            times = np.where(is_hot, windows, 1)
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            start, offset = np.repeat(start, times) + step, np.repeat(offset, times) - step
            h, text, windows, is_hot = np.repeat(h, times), np.repeat(text, times), np.repeat(np.where(is_hot, 1, windows), times), np.repeat(is_hot, times)
        begins = np.r_[0, ends[:-1]]
        rows = np.lib.stride_tricks.sliding_window_view(buffer, shape.width)[start]
        rows = np.where(np.arange(shape.width) < (windows + shape.window - 1)[:, None], rows, 0).astype(np.uint8)
        parts.append((h, offset, windows, is_hot, rows, text + first, start - begins[text]))
    if not parts:
        zero = np.zeros(0, np.int64)
        return Runs(zero.astype(U), zero.astype(U), zero, zero, np.zeros((0, shape.width), np.uint8), zero, zero, zero, zero)
    h, offset, windows, is_hot, rows, text, start = (np.concatenate(x) for x in zip(*parts, strict=True))
    digest = _digest(rows, offset, windows)
    route = np.where(is_hot, _stir(h * MIX[2] + digest) >> U(64 - shape.bits), h)
    order = np.lexsort((digest, h, route))
    h, offset, windows, rows, text, start, digest, route = (x[order] for x in (h, offset, windows, rows, text, start, digest, route))
    same = (h[1:] == h[:-1]) & (digest[1:] == digest[:-1]) & (offset[1:] == offset[:-1]) & (windows[1:] == windows[:-1])
    same[same] = (rows[1:][same] == rows[:-1][same]).all(axis=1)
    new = np.flatnonzero(np.r_[True, ~same]) if len(h) else np.zeros(0, np.int64)
    entry = np.cumsum(np.r_[0, ~same]) if len(h) else new
    least = np.minimum.reduceat(ids[text], new) if len(new) else new
    return Runs(route[new], h[new], offset[new], windows[new], rows[new], least, entry, text, start)


def _digest(rows: np.ndarray, offset: np.ndarray, windows: np.ndarray) -> np.ndarray:
    eight = rows.view("<u8")
    digest = offset.astype(U) * MIX[4] + windows.astype(U) * MIX[5]
    for k in range(eight.shape[1]):
        digest = _stir(digest + eight[:, k] * MIX[k % len(MIX)])
    return digest


def send_runs(table: pa.Table, payloads: list[bytes], shape: Shape) -> Iterator[tuple]:
    """(bucket, hash, offset, windows, least, content), each but the first packed."""
    ids, texts = _texts(table)
    wanted = np.sort(np.concatenate([unpack(p) for p in payloads])) if payloads else np.zeros(0, U)
    runs = gather_runs(ids, texts, wanted, shape)
    for bucket, s in _slices(_bucket(runs.route, shape)):
        yield bucket, squeeze(runs.hash[s]), squeeze(runs.offset[s].astype(np.uint16)), squeeze(runs.windows[s].astype(np.uint16)), squeeze(runs.least[s]), squeeze(runs.content[s])


def least_documents(h: np.ndarray, offset: np.ndarray, windows: np.ndarray, least: np.ndarray, content: np.ndarray, shape: Shape) -> np.ndarray:
    """For every window of every row, in order, the least document of all equal windows: the radix sort."""
    order = np.lexsort((_digest(content, offset, windows), h))
    hs, os, ws, rows = h[order], offset[order], windows[order], content[order]
    same = (hs[1:] == hs[:-1]) & (os[1:] == os[:-1]) & (ws[1:] == ws[:-1])
    same[same] = (rows[1:][same] == rows[:-1][same]).all(axis=1)
    new = np.flatnonzero(np.r_[True, ~same])
    row_of = np.empty(len(h), np.int64)
    row_of[order] = np.cumsum(np.r_[0, ~same])
    lowest = np.minimum.reduceat(least[order], new)
    hs, os, ws, rows = hs[new], os[new], ws[new], np.ascontiguousarray(rows[new])

    first = np.cumsum(ws) - ws
    best = np.repeat(lowest, ws)
    owner = np.repeat(np.arange(len(ws)), ws)
    step = np.arange(len(owner)) - first[owner]
    anchors = np.cumsum(np.r_[0, hs[1:] != hs[:-1]])
    alive = np.flatnonzero((np.bincount(anchors) > 1)[anchors[owner]])
    group = anchors[owner[alive]] * 65536 + os[owner[alive]] - step[alive]
    digits = np.ndarray((len(rows), shape.width - 7), ">u8", rows, 0, (shape.width, 1))
    for at in range(0, shape.window, 8):
        if not len(alive):
            break
        begin = min(at, shape.window - 8)
        digit = digits[owner[alive], step[alive] + begin].astype(U)
        order = np.lexsort((digit, group))
        alive, group, digit = alive[order], group[order], digit[order]
        new = np.r_[True, (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])]
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1
        alive, group = alive[several], group[several]
    if len(alive):
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        best[alive] = np.repeat(np.minimum.reduceat(best[alive], starts), np.diff(np.r_[starts, len(alive)]))
    times = windows
    at = np.repeat(first[row_of], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return best[at]


def answer_runs(blocks: list[int], columns: list[list[bytes]], shape: Shape) -> Iterator[tuple]:
    """(block, run lengths, values): the least document of each window of a block's rows, in order."""
    kinds = (U, np.uint16, np.uint16, np.int64, np.uint8)
    got = [[unsqueeze(c, kind) for c in column] for column, kind in zip(columns, kinds, strict=True)]
    sizes = [len(x) for x in got[0]]
    h, offset, windows, least, content = (np.concatenate(x) for x in got)
    best = least_documents(h, offset.astype(np.int64), windows.astype(np.int64), least, content.reshape(-1, shape.width), shape)
    ends = np.cumsum(windows.astype(np.int64))
    row = window = 0
    for block, size in zip(blocks, sizes, strict=True):
        until = int(ends[row + size - 1]) if size else window
        own = best[window:until]
        cuts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        yield block, squeeze(np.diff(np.r_[cuts, len(own)]).astype(np.int32)), squeeze(own[cuts])
        row, window = row + size, until


def remove_repeats(table: pa.Table, wanted: list[bytes], answers: list[tuple[int, bytes, bytes]], shape: Shape) -> Iterator[tuple[int, bytes, int, int]]:
    """(place of the text, what is left, bytes removed, runs removed)."""
    ids, texts = _texts(table)
    names = np.sort(np.concatenate([unpack(p) for p in wanted])) if wanted else np.zeros(0, U)
    runs = gather_runs(ids, texts, names, shape)
    best = [np.repeat(unsqueeze(values, np.int64), unsqueeze(lengths, np.int32)) for _, lengths, values in sorted(answers)]
    best = np.concatenate(best) if best else np.zeros(0, np.int64)
    first = np.cumsum(runs.windows) - runs.windows
    times = runs.windows[runs.entry]
    step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    gone = best[np.repeat(first[runs.entry], times) + step] < np.repeat(ids[runs.text], times)
    text, start = np.repeat(runs.text, times)[gone], (np.repeat(runs.start, times) + step)[gone]
    order = np.argsort(text, kind="stable")
    text, start = text[order], start[order]
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    for k, data in enumerate(texts):
        own = start[cuts[k] : cuts[k + 1]]
        if not len(own):
            yield k, data, 0, 0
            continue
        change = np.zeros(len(data) + 1, np.int32)
        np.add.at(change, own, 1)
        np.add.at(change, own + shape.window, -1)
        covered = np.cumsum(change[:-1]) > 0
        spans = int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
        yield k, np.frombuffer(data, np.uint8)[~covered].tobytes(), int(covered.sum()), spans


def _rows(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def deal_sizes(total: int, block_bytes: int, bucket_bytes: int, least_message: int = LEAST_MESSAGE) -> tuple[int, int]:
    """(number of blocks, number of buckets): blocks and buckets are enlarged alike until a message has `least_message` anchors."""
    grow = max(1.0, math.sqrt(total * ANCHOR_BYTES * least_message / (block_bytes * bucket_bytes)))
    return max(1, int(total / (block_bytes * grow))), max(1, int(total / (bucket_bytes * grow)))


def remove_repeated_windows(
    docs: DataFrame,
    window: int = 50,
    keep: tuple[str, ...] = (),
    block_bytes: int = 4 << 20,
    bucket_bytes: int = 8 << 20,
    hot_blocks: int = 4096,
) -> DataFrame:
    """doc_id, `keep`, n_bytes, n_removed, n_spans, text, kept_sha256: one row for each row of docs.

    kept_sha256 is of the bytes that are left; text is what is left of whole characters.

    Texts are UTF-8 bytes, null is empty; other bytes count like any, and text keeps them where nothing
    is removed. Every byte goes that is covered by a `window`-byte string
    that also starts in a document with a smaller doc_id; a null doc_id is greater than any other,
    and rows with equal doc_id do not count against each other, so repeated rows lose the same bytes. Texts shorter than a window are
    left alone; an empty table gives no rows. A block holds about `block_bytes` of texts and a bucket
    the anchors of about `bucket_bytes`, both more by one factor, the root of the input's size over 2 GB:
    some 15 and 30 MB at 30 GB, 280 and 570 MB at 10 TB. Columns outside doc_id, text and `keep` are not
    read, and one in `keep` that has the name of a result is left out. doc_id is an integer.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = deal_sizes(total, block_bytes, bucket_bytes)
    anchor = max(8, window * 2 // 5)
    shape = Shape(window, anchor, min(61, max(32, int(total).bit_length() + 14)), buckets)
    binary, i32 = pa.binary(), pa.int32()
    dealt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    extra = [c for c in keep if c not in RESULTS]
    placed = docs.select(dealt.alias("__block"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *extra)

    def report(table: pa.Table) -> pa.Table:
        block = table.column("__block")[0].as_py()
        return _rows(["bucket", "block", "anchors"], [i32, i32, binary], [(b, block, p) for b, p in report_anchors(table, shape)])

    def repeated(table: pa.Table) -> pa.Table:
        return _rows(["block", "anchors"], [i32, binary], list(repeated_anchors(table.column("block").to_pylist(), table.column("anchors").to_pylist(), hot_blocks)))

    def send(texts: pa.Table, told: pa.Table) -> pa.Table:
        names, kinds = ["bucket", "block", "hash", "offset", "windows", "least", "content"], [i32, i32, *[binary] * 5]
        if not texts.num_rows or not told.num_rows:
            return _rows(names, kinds, [])
        block = texts.column("__block")[0].as_py()
        return _rows(names, kinds, [(b, block, *rest) for b, *rest in send_runs(texts, told.column("anchors").to_pylist(), shape)])

    def answer(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        columns = [table.column(c).to_pylist() for c in ("hash", "offset", "windows", "least", "content")]
        rows = [(block, bucket, None, lengths, values) for block, lengths, values in answer_runs(table.column("block").to_pylist(), columns, shape)]
        return _rows(["block", "bucket", "anchors", "lengths", "values"], [i32, i32, binary, binary, binary], rows)

    def remove(texts: pa.Table, told: pa.Table) -> pa.Table:
        if not texts.num_rows:
            texts = texts.slice(0, 0)
        rows = told.to_pylist()
        wanted = [r["anchors"] for r in rows if r["anchors"] is not None]
        answers = [(r["bucket"], r["lengths"], r["values"]) for r in rows if r["anchors"] is None]
        done = sorted(remove_repeats(texts, wanted, answers, shape)) if texts.num_rows else []
        kept = [text for _, text, _, _ in done]
        return pa.table({
            "doc_id": texts.column("doc_id"),
            **{c: texts.column(c) for c in extra},
            "n_bytes": pa.array([len(text) + removed for _, text, removed, _ in done], pa.int64()),
            "n_removed": pa.array([removed for _, _, removed, _ in done], pa.int64()),
            "n_spans": pa.array([spans for _, _, _, spans in done], pa.int64()),
            "text": pa.array([text.decode("utf-8", "ignore").encode() if removed else text for _, text, removed, _ in done], pa.binary()),
            "kept_sha256": pa.array([hashlib.sha256(text).hexdigest() for text in kept], pa.string()),
        })

    reported = placed.groupBy("__block").applyInArrow(report, "bucket int, block int, anchors binary")
    told = reported.groupBy("bucket").applyInArrow(repeated, "block int, anchors binary")
    sent = placed.groupBy("__block").cogroup(told.groupBy("block")).applyInArrow(send, "bucket int, block int, hash binary, offset binary, windows binary, least binary, content binary")
    answered = sent.groupBy("bucket").applyInArrow(answer, "block int, bucket int, anchors binary, lengths binary, values binary")
    null = F.lit(None)
    heard = told.select("block", null.cast("int").alias("bucket"), "anchors", null.cast("binary").alias("lengths"), null.cast("binary").alias("values")).unionByName(answered)
    kinds = "".join(f", `{c}` {placed.schema[c].dataType.simpleString()}" for c in extra)
    schema = f"doc_id bigint{kinds}, n_bytes bigint, n_removed bigint, n_spans bigint, text binary, kept_sha256 string"
    left = placed.groupBy("__block").cogroup(heard.groupBy("block")).applyInArrow(remove, schema)
    return left.withColumn("text", F.col("text").cast("string"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(read_table(spark, sf_dir, "documents")).drop("text")


#: Windows as hex digits, cut from short pieces of each text.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
q AS (SELECT doc_id, k * 256 AS base, substr(h, 512 * k + 1, 610) AS piece FROM (SELECT doc_id, h, unnest(range(0, length(h) // 512 + 1)) AS k FROM d)),
w AS (SELECT doc_id, base + j AS i, substr(piece, 2 * j + 1, 100) AS s FROM (SELECT doc_id, base, piece, unnest(range(0, least(256, length(piece) // 2 - 49))) AS j FROM q)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING count(DISTINCT doc_id) > 1),
c AS (SELECT w.doc_id, w.i FROM w JOIN f ON w.s = f.s WHERE f.first < w.doc_id),
r AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM c)),
s AS (SELECT doc_id, min(i) AS b, max(i) + 50 AS e FROM r GROUP BY doc_id, run),
p AS (SELECT s.doc_id, b, e, substr(h, 2 * lag(e, 1, 0) OVER (PARTITION BY s.doc_id ORDER BY b) + 1, 2 * (b - lag(e, 1, 0) OVER (PARTITION BY s.doc_id ORDER BY b))) AS before FROM s JOIN d ON s.doc_id = d.doc_id),
g AS (SELECT doc_id, count(*) AS n_spans, sum(e - b) AS n_removed, max(e) AS last, string_agg(before, '' ORDER BY b) AS kept FROM p GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""
