"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document; the ledger keeps the measurements and a mask
with a bit for each failed rule. A policy is a mask of the rules that count, with a version, so
applying a new policy, or asking what a rule costs, is bit arithmetic over the ledger alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonorum.llm.common import SPACE_CHARS, let, read_table, split_words

#: Words of a window; a power of two.
WINDOW = 8
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: Name of each rule and when a document fails it, over the measurements. The place is the bit.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("word_length", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 14 * n_words)"),
)
#: Version -> names of the rules that count.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("few_words", "repeated_words"),
    "v2": ("few_words", "repeated_words", "symbols", "repeated_lines", "word_length"),
}


def rule_mask(names: tuple[str, ...]) -> int:
    bits = {name: 1 << k for k, (name, _) in enumerate(RULES)}
    return sum(bits[name] for name in names)


def _covered(starts: Column) -> Column:
    """Words under windows at these ascending starts."""
    gaps = F.zip_with(F.slice(starts, F.lit(2), F.size(starts) - 1), F.slice(starts, F.lit(1), F.size(starts) - 1), lambda b, a: F.least(b - a, F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)


def repeated_words(words: Column) -> Column:
    """Words in windows of eight words that are found twice or more in the row's own words.

    Windows are compared by a 64-bit hash of their words in order, made of the hashes of their halves.
    """
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def count(windows: Column) -> Column:
        ranked = F.array_sort(F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))

        def starts(s: Column) -> Column:
            same = F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]))
            return F.array_sort(F.transform(same, lambda x: x["k"]))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(ranked, lambda s: let(starts(s), _covered)))

    def doubled(step: int):
        """Hashes of runs of 2 * step words from those of step words."""
        return lambda h: F.zip_with(F.slice(h, F.lit(1), F.size(h) - step), F.slice(h, F.lit(1 + step), F.size(h) - step), lambda a, b: F.xxhash64(a, b))

    windows, step = hashed, 1
    while step < WINDOW:
        windows, step = let(windows, doubled(step)), step * 2
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(windows, count)).cast("long")


def ledger(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """One row for each row of docs: `keep`, the measurements, failed int (bit k: rule k failed).

    Null, empty and blank texts have no words, no lines and no symbols, and fail few_words. Whole texts
    are measured, however long; equal lines or windows all count but the first line. Other
    columns of docs are not read; repeated rows stay repeated; an empty table gives an empty ledger.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(*keep, text.alias("__text"), split_words(F.col(text_col)).alias("__words"))
    lines = F.filter(F.split("__text", "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")
    base = base.withColumn("__lines", lines)
    measured = base.select(
        *keep,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.translate("__text", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("__words")).alias("n_repeat_words"),
    )
    failed = sum((F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, rule) in enumerate(RULES)), F.lit(0))
    return measured.withColumn("failed", failed)


def apply_policy(ledger_df: DataFrame, version: str, name: str = "kept") -> DataFrame:
    """Adds a boolean: no rule of the policy failed."""
    return ledger_df.withColumn(name, F.col("failed").bitwiseAND(F.lit(rule_mask(POLICIES[version]))) == 0)


def ablation(ledger_df: DataFrame, version: str) -> DataFrame:
    """One row for each rule of a policy: documents that fail it, and documents that only it removes.

    One partial and final aggregation over the masks; an empty ledger gives zeros.
    """
    mask = rule_mask(POLICIES[version])
    hit = F.col("failed").bitwiseAND(F.lit(mask))
    stats = []
    for k, (name, _) in enumerate(RULES):
        if mask >> k & 1:
            stats.append(F.struct(
                F.lit(name).alias("rule"),
                F.count_if(F.col("failed").bitwiseAND(F.lit(1 << k)) != 0).alias("n_failed"),
                F.count_if(hit == (1 << k)).alias("n_only"),
                F.coalesce(F.bit_or(F.when(F.col("failed").bitwiseAND(F.lit(1 << k)) != 0, F.col("failed"))), F.lit(0)).alias("seen_with"),
            ))
    return ledger_df.agg(F.array(*stats).alias("stats")).select(F.explode("stats").alias("s")).select("s.*")


def op6_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(read_table(spark, sf_dir, "documents")), "v2")
    base = F.col("failed").bitwiseAND(F.lit(rule_mask(POLICIES["v1"]))) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failed")


def op6_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the second policy removes, and removes alone."""
    return ablation(ledger(read_table(spark, sf_dir, "documents")), "v2")


_LEDGER_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT doc_id, i, list_reduce(w[i:i + 7], lambda a, b: a || ' ' || b) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) > 8)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rep, (SELECT unnest(range(0, 8)) AS j) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id),
f AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 14 * n_words) THEN 16 ELSE 0 END) AS failed
  FROM m)
"""
ORACLE_SQL = _LEDGER_SQL + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, CAST(failed AS INTEGER) AS failed FROM f
"""
ABLATION_SQL = _LEDGER_SQL + """
SELECT rule, count(*) FILTER (WHERE failed & bit <> 0) AS n_failed, count(*) FILTER (WHERE failed = bit) AS n_only,
  CAST(coalesce(bit_or(CASE WHEN failed & bit <> 0 THEN failed END), 0) AS INTEGER) AS seen_with
FROM f, (VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('repeated_lines', 8), ('word_length', 16)) AS r(rule, bit)
GROUP BY rule
"""
