"""Token alignment against a walk over both token lists, and on awkward texts."""

import hashlib
from collections import Counter

import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sonorum.llm import alignment

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def own():
    return alignment.Tokenizers.read()


def walked(own, rows):
    """Of each text its numbers of tokens, links, and digest, by a walk over whole texts; and the counts of all pairs."""
    a_own = Tokenizer.from_file(f"{alignment.TOKENIZERS}/{alignment.A_FILE}")
    a_own.encode_special_tokens = True
    b_own = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.TOKENIZERS}/{alignment.B_FILE}")
    found, counts = [], Counter()
    for text in rows:
        a = a_own.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_own.encode(text) if text else []
        whole = f" {text}".encode() if text else b""
        if b"".join(own.a_bytes[i] for i in a) != whole or b"".join(own.b_bytes[i] for i in b) != whole:
            a, b = [], []
        groups, links, one, other, size = [], [], [], [], [0, 0]
        a, b = list(a), list(b)
        n = (len(a), len(b))
        while a or b:
            side = size[0] > size[1]
            (other if side else one).append((b if side else a).pop(0))
            size[side] += len(own.b_bytes[other[-1]] if side else own.a_bytes[one[-1]])
            if size[0] == size[1]:
                groups.append(",".join(map(str, one)) + "|" + ",".join(map(str, other)))
                links.append((one[-1], other[-1]))
                one, other = [], []
        counts.update(links)
        found.append((*n, links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(a, b, len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), digest) for a, b, x, digest in found], counts


def test_table_against_a_walk(spark, own):
    rows = duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet' order by doc_id").fetchall()
    want, _ = walked(own, [t for _, t in rows])
    got = {r["doc_id"]: (r["n_a"], r["n_b"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in alignment.op13_token_alignment(spark, SMALL).collect()}
    assert got == {i: w for (i, _), w in zip(rows, want, strict=True)}


TEXTS = [
    None, "", " ", "one", "one", "<|endoftext|> <s> </s> <unk>", "tab\tline\n\ntwo  spaces ", "日本語 テキスト ñandú Äpfel 👩‍👧", "a▁b", "\x00 nul", "unbelievably antidisestablishmentarian " * 30,
    "x" * 3000, "word " * 50 + "1234567890 " * 50,
]


@pytest.mark.parametrize("frequent", [100_000, 3])
def test_awkward_texts_and_rare_pairs(spark, own, frequent):
    rows = [(i if i != 3 else None, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for name in ("row", "rest", "regular", "a_ids", "n", "pair"):
        docs = docs.withColumn(name, F.lit("x"))
    linked = alignment.materialize(alignment.align(docs, own, tokens=False, links=True), "linked")
    want, counts = walked(own, TEXTS)
    pairs = alignment.pair_counts(linked, own)
    assert {(r["a"], r["b"]): r["n"] for r in pairs.collect()} == counts
    got = alignment.link_sums(linked, pairs, own, frequent).collect()
    assert sorted((r["n_a"], r["n_b"], r["n_groups"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in got) == sorted(want)
    assert sum(r["doc_id"] is None for r in got) == 1


def test_groups_cover_the_text(spark, own):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    for r in alignment.align(docs, own).collect():
        whole = b""
        for k, (a, b) in enumerate(zip(r["a_ends"], r["b_ends"], strict=True)):
            part = b"".join(own.a_bytes[i] for i in r["a_ids"][r["a_ends"][k - 1] if k else 0 : a])
            assert part == b"".join(own.b_bytes[i] for i in r["b_ids"][r["b_ends"][k - 1] if k else 0 : b])
            whole += part
        assert whole in (b"", f" {TEXTS[r['doc_id']]}".encode())


def test_bytes_that_are_no_text_have_no_tokens(spark, own):
    docs = spark.createDataFrame([(1, b"\xff\xfe abc"), (2, b"abc")], "doc_id bigint, text binary")
    assert {r["doc_id"]: r["n_a"] > 0 for r in alignment.align(docs, own).collect()} == {1: False, 2: True}


def test_an_empty_table(spark, own):
    linked = alignment.align(spark.createDataFrame([], "doc_id bigint, text string"), own, tokens=False, links=True)
    assert alignment.link_sums(linked, alignment.pair_counts(linked, own), own).isEmpty()


def test_parts_have_the_tokens_of_the_whole(own):
    text = " ".join(["plain words", "und ein längerer Satz", "1 2 3", "don't  stop", "日本 語 テキスト"] * 200)
    parts = alignment.chunks(text, 50)
    assert len(parts) > 50 and " ".join(parts) == text
    (a, b), = alignment.encode(own, [text.encode()])
    assert a.tolist() == own.a(f" {text}") and b.tolist() == own.b.encode(text)
    assert [i for p in parts for i in own.a(f" {p}")] == a.tolist()
    assert [i for p in parts for i in own.b.encode(p)] == b.tolist()
    assert not any("▁" in own.b.id_to_piece(i).lstrip("▁") for i in range(own.b.get_piece_size()))  # so no piece goes on over a space


def test_encoder_gives_the_tokens_of_the_file(own):
    """Every token of the vocabulary, and texts of all kinds."""
    file = Tokenizer.from_file(f"{alignment.TOKENIZERS}/{alignment.A_FILE}")
    file.encode_special_tokens = True
    tokens = [t.decode(errors="ignore") for t in own.a_bytes]
    texts = duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet' where text is not null").fetchall()
    for text in [*tokens, *filter(None, TEXTS), *(t for (t,) in texts), "a" + " " * 200_000 + "b", "\n" * 50_000, "x" * 200_000]:
        assert own.a(text) == file.encode(text, add_special_tokens=False).ids
