"""From encoder states to ranked labels: array expressions, one row for each clip, no shuffle after pooling."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonorum.session import stored


def mean_pool(frames: DataFrame, key: str, vec: str = "vec") -> DataFrame:
    """key, features: the mean over a key's rows, padding frames included. Partial sums on each task, then one shuffle of them."""
    pooled = frames.groupBy(key).agg(Summarizer.mean(array_to_vector(F.col(vec).cast("array<double>"))).alias("mean"))
    return pooled.select(key, vector_to_array("mean").alias("features"))


def mean_pool_long(frames: DataFrame, key: str, vec: str = "vec") -> DataFrame:
    """key, dim, value: the same means, a row for each dimension."""
    return frames.select(key, F.posexplode(vec).alias("dim", "x")).groupBy(key, "dim").agg(F.avg(F.col("x").cast("double")).alias("value"))


#: Bytes of a packed head or label map that may be broadcast.
MAX_PACKED_BYTES = 64 << 20


def _packed(column: Column, n_bytes: Column, what: str, other: str) -> Column:
    """column, or an error where its bytes are too many to be broadcast."""
    words = F.format_string(f"a {what} of %s bytes is too large to be broadcast (at most {MAX_PACKED_BYTES}); use {other}", n_bytes.cast("bigint"))
    return F.when(F.coalesce(n_bytes, F.lit(0)) > MAX_PACKED_BYTES, F.raise_error(words)).otherwise(column)


def _class_rows() -> Column:
    return F.struct("class_idx", F.col("weight").cast("array<double>").alias("weight"), F.col("bias").cast("double").alias("bias"))


def pack_head(head: DataFrame) -> DataFrame:
    """head (class_idx, weight array, bias) as one row with an array ordered by class; larger than MAX_PACKED_BYTES it is an error when run."""
    size = F.sum(F.size("weight") * 8 + 16)
    return head.agg(F.sort_array(F.collect_list(_class_rows())).alias("head"), size.alias("bytes")).select(_packed(F.col("head"), F.col("bytes"), "head", "linear_head_in_blocks or classify_in_blocks").alias("head"))


def _logit(column: str):
    def logit(c: Column) -> Column:
        products = F.zip_with(F.col(column).cast("array<double>"), c["weight"], lambda x, w: x * w)
        return F.struct(c["class_idx"].alias("class_idx"), F.aggregate(products, c["bias"], lambda s, p: s + p).alias("z"))

    return logit


def linear_head(features: DataFrame, head: DataFrame, column: str = "features") -> DataFrame:
    """features with logits array<struct<class_idx, z>>, z = weight . x + bias. The packed head is one row, so the join is a broadcast of it."""
    return features.crossJoin(F.broadcast(pack_head(head))).withColumn("logits", F.transform("head", _logit(column))).drop("head")


def _blocks_of(head: DataFrame, rows: Column, block_classes: int, salts: int) -> DataFrame:
    """block, salt, head: `block_classes` classes a row, each row once for each salt."""
    blocks = head.withColumn("block", F.floor(F.col("class_idx") / block_classes)).groupBy("block").agg(F.collect_list(rows).alias("head"))
    return blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def _at_blocks(features: DataFrame, head: DataFrame, blocks: DataFrame, block_classes: int, salts: int) -> DataFrame:
    """features (with row) copied to every block of classes. A block's copies are dealt over `salts` join keys, so a head of few blocks uses all tasks."""
    numbers = head.select(F.floor(F.col("class_idx") / block_classes).alias("block")).distinct().agg(F.collect_list("block").alias("blocks"))
    copied = features.crossJoin(F.broadcast(numbers)).withColumn("block", F.explode_outer("blocks")).drop("blocks")
    return copied.withColumn("salt", F.pmod(F.col("row"), F.lit(salts)).cast("int")).join(blocks, ["block", "salt"], "left")


def _numbered(df: DataFrame) -> DataFrame:
    return stored(df.withColumn("row", F.monotonically_increasing_id()), "features")


def linear_head_in_blocks(features: DataFrame, head: DataFrame, key: str, column: str = "features", block_classes: int = 4096, salts: int = 16) -> DataFrame:
    """key, column, logits: the same for a head of any size, one row for each row of features, whatever their keys.

    Every block of classes is a row, to which numbered copies of the features are joined; a row's logits are put together again by its number.
    """
    rows = _numbered(features.select(key, column))
    scored = _at_blocks(rows, head, _blocks_of(head, _class_rows(), block_classes, salts), block_classes, salts)
    parts = scored.select("row", F.transform("head", _logit(column)).alias("part"))
    merged = parts.groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("part"))).alias("logits"))
    return rows.join(merged, "row").select(key, column, "logits")


def classify_in_blocks(
    features: DataFrame, head: DataFrame, labels: DataFrame, k: Column | int = 5, keep: tuple[str, ...] = ("clip_id",), column: str = "features", block_classes: int = 4096, salts: int = 16
) -> DataFrame:
    """What classify_features gives, for a head and labels of any size.

    Of a block of classes a row gets its k greatest logits, the greatest, and the sum of powers below it. Only these k candidates and
    two numbers a block are shuffled; sums are brought to the greatest logit of all blocks, and the k best of the
    candidates are those of all classes, by logit, equal ones by class. Rows are numbered, so equal ones stay apart.
    """
    names = labels.groupBy("class_idx").agg(F.min("intent").alias("intent"))
    named = head.join(names, "class_idx", "left")
    counts = head.agg(F.count(F.lit(1)).alias("n_classes")).crossJoin(labels.agg(F.count(F.lit(1)).alias("n_labels")))  # one row each
    rows = _numbered(features.select(*keep, F.col(column).alias("__x"), (F.lit(k) if isinstance(k, int) else k).alias("__k")))
    blocks = _blocks_of(named, F.struct("class_idx", F.col("weight").cast("array<double>").alias("weight"), F.col("bias").cast("double").alias("bias"), "intent"), block_classes, salts)
    logit = _logit("__x")

    def negated(c: Column) -> Column:
        found = logit(c)
        return F.struct((-found["z"]).alias("minus"), c["class_idx"].alias("class_idx"), c["intent"].alias("intent"))

    scored = _at_blocks(rows, head, blocks, block_classes, salts).select(*keep, "row", "__k", F.array_sort(F.transform("head", negated)).alias("ranked"))
    least = F.get("ranked", F.lit(0))["minus"]
    powers = F.aggregate("ranked", F.lit(0.0), lambda total, c: total + F.exp(least - c["minus"]))
    parts = scored.select(*keep, "row", "__k", (-least).alias("top"), powers.alias("powers"), F.slice("ranked", F.lit(1), F.least(F.col("__k"), F.size("ranked"))).alias("best"))
    kept = [F.first(c).alias(c) for c in (*keep, "__k")]
    merged = parts.groupBy("row").agg(*kept, F.max("top").alias("top"), F.collect_list(F.struct("top", "powers", "best")).alias("parts")).crossJoin(F.broadcast(counts))
    total = F.aggregate("parts", F.lit(0.0), lambda s, part: s + part["powers"] * F.exp(part["top"] - F.col("top")))
    ranked = F.array_sort(F.flatten(F.transform("parts", lambda part: part["best"])))
    ranked = F.slice(ranked, F.lit(1), F.least(F.col("__k"), F.col("n_labels").cast("int"), F.size(ranked)))
    merged = merged.withColumn("total", total).withColumn("ranked", F.when(F.col("n_classes") == F.col("n_labels"), ranked))
    intents = F.transform("ranked", lambda c: F.struct(c["intent"].alias("intent"), (F.exp(-c["minus"] - F.col("top")) / F.col("total")).alias("confidence")))
    merged = merged.withColumn("intents", F.when(~F.exists("ranked", lambda c: c["intent"].isNull()), intents))
    best = F.get("intents", F.lit(0))
    return merged.select(*keep, "intents", best["intent"].alias("top_intent"), best["confidence"].alias("confidence"))


def check_width(df: DataFrame, n_classes: int, column: str = "logits") -> DataFrame:
    """Adds width_ok: as many logits as classes; null logits are wrong."""
    return df.withColumn("width_ok", F.coalesce(F.size(column) == n_classes, F.lit(False)))


def softmax(logits: Column) -> Column:
    """array<struct<class_idx, z>> to array<struct<class_idx, p>>; the greatest logit is taken off first."""
    top = F.array_max(F.transform(logits, lambda c: c["z"]))
    powers = F.transform(logits, lambda c: F.struct(c["class_idx"].alias("class_idx"), F.exp(c["z"] - top).alias("e")))
    total = F.aggregate(powers, F.lit(0.0), lambda s, c: s + c["e"])
    return F.transform(powers, lambda c: F.struct(c["class_idx"].alias("class_idx"), (c["e"] / total).alias("p")))


def softmax_long(logits: DataFrame, key: str) -> DataFrame:
    """key, class_idx, z with p: the same over rows."""
    w = Window.partitionBy(key)
    powers = logits.withColumn("e", F.exp(F.col("z") - F.max("z").over(w)))
    return powers.withColumn("p", F.col("e") / F.sum("e").over(w)).drop("e")


def top_k(probabilities: Column, k: Column) -> Column:
    """The k best of array<struct<class_idx, p>>, best first, equal ones by class_idx; k is of the row."""
    ranked = F.array_sort(F.transform(probabilities, lambda c: F.struct((-c["p"]).alias("minus"), c["class_idx"].alias("class_idx"))))
    return F.transform(F.slice(ranked, F.lit(1), F.least(k, F.size(ranked))), lambda c: F.struct(c["class_idx"].alias("class_idx"), (-c["minus"]).alias("p")))


def top_k_rows(long: DataFrame, key: str, k: int | str) -> DataFrame:
    """key, class_idx, p, rank: the same over rows; k is a number or a column."""
    w = Window.partitionBy(key).orderBy(F.col("p").desc(), "class_idx")
    limit = F.lit(k) if isinstance(k, int) else F.col(k)
    return long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def top_1(probabilities: Column) -> Column:
    return F.get(top_k(probabilities, F.lit(1)), F.lit(0))


def top_1_rows(long: DataFrame, key: str) -> DataFrame:
    """key, class_idx, p of the best class, as an aggregation: no sort and partial results on each task."""
    best = F.struct(F.col("p"), (-F.col("class_idx")).alias("minus"))
    return long.groupBy(key).agg(F.max_by("class_idx", best).alias("class_idx"), F.max("p").alias("p"))


def check_confidence(p: Column) -> Column:
    """In 0..1; null and NaN are not."""
    return F.coalesce(~F.isnan(p) & (p >= 0) & (p <= 1), F.lit(False))


def pack_labels(labels: DataFrame) -> DataFrame:
    """One row: n_labels and names map<class_idx, intent>; larger than MAX_PACKED_BYTES it is an error when run."""
    size = F.sum(F.coalesce(F.octet_length("intent"), F.lit(0)) + 16)
    packed = labels.agg(F.count(F.lit(1)).cast("int").alias("n_labels"), F.map_from_entries(F.collect_list(F.struct("class_idx", "intent"))).alias("names"), size.alias("bytes"))
    return packed.select("n_labels", _packed(F.col("names"), F.col("bytes"), "label map", "top_k_rows and attach_labels").alias("names"))


def named_intents(ranked: Column, names: Column) -> Column:
    """array<struct<intent, confidence>> in rank order, null where an index has no label."""
    found = F.transform(ranked, lambda c: F.struct(F.try_element_at(names, c["class_idx"]).alias("intent"), c["p"].alias("confidence")))
    return F.when(~F.exists(found, lambda i: i["intent"].isNull()), found)


def classify_features(features: DataFrame, head: DataFrame, labels: DataFrame, k: Column | int = 5, keep: tuple[str, ...] = ("clip_id",)) -> DataFrame:
    """`keep`, intents, top_intent, confidence: head, softmax, top k and labels, one row for each row of features.

    intents is null where a class has no label or the logits are not one for each label. Head and
    labels are one broadcast row each, so clips stay one row and nothing is run before the result is asked for.
    """
    k = F.lit(k) if isinstance(k, int) else k
    scored = linear_head(features, head).crossJoin(F.broadcast(pack_labels(labels)))
    wide = F.size("logits") == F.col("n_labels")
    scored = scored.withColumn("ranked", F.when(wide, top_k(softmax(F.col("logits")), F.least(k, F.col("n_labels")))))
    named = scored.withColumn("intents", named_intents(F.col("ranked"), F.col("names")))
    best = F.get("intents", F.lit(0))
    return named.select(*keep, "intents", best["intent"].alias("top_intent"), best["confidence"].alias("confidence"))
