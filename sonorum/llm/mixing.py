"""Mixing sources to target weights by subset-sum budget fitting.

A source's target is met with whole documents, each taken not at all, once or twice. Documents are
counted by exact length. Each length first gives its even share of the target; a bounded knapsack
over the lengths then takes some more and gives some back until the words are as near the target as
they can be. The documents of a length are taken in the order of a seeded hash.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonorum.llm.common import materialize, read_table, split_words

#: How far from the even share the fit looks, in words, one step after the other while the target is not met exactly.
REACHES = (1 << 14, 1 << 18, 1 << 22)
#: Different sums that the search over all selections may hold.
ALL_SUMS = 1 << 22


def _moves(lengths: list[int], least: list[int], most: list[int]) -> list[tuple[int, int]]:
    """(length, times) so that every number of times from `least` (at most 0) to `most` is a sum of some: powers of two and a rest."""
    found = []
    for n, down, up in sorted(zip(lengths, least, most, strict=True)):
        for left, sign in ((up, 1), (-down, -1)):
            step = 1
            while left > 0:
                k = min(step, left)
                found.append((n, sign * k))
                left, step = left - k, step * 2
    return found


def fit_moves(lengths: list[int], least: list[int], most: list[int], wanted: float, reach: int) -> dict[int, int]:
    """length -> how many more (or, below 0, fewer) documents to take so that their words come nearest `wanted`.

    Bounded knapsack over the sums from -reach to reach that single moves lead to, reachable sums as the
    bits of one integer, which begin at -reach. A sum remembers the move that first reached it. It
    ends early where no other sum could be nearer. Of two sums as near the lesser is taken.
    """
    goal = math.ceil(wanted - 0.5) + reach
    mask, reached, first = (1 << 2 * reach + 1) - 1, 1 << reach, np.full(2 * reach + 1, -1, np.int32)
    moves = _moves(lengths, least, most)
    for number, (length, times) in enumerate(moves):
        if reached >> goal & 1:
            break
        by = length * times
        new = (reached << by if by > 0 else reached >> -by) & mask & ~reached if abs(by) <= 2 * reach else 0
        if new:
            bits = np.unpackbits(np.frombuffer(new.to_bytes(reach // 4 + 1, "little"), np.uint8), bitorder="little")
            first[np.flatnonzero(bits[: 2 * reach + 1])] = number
            reached |= new
    below = (reached & (1 << goal + 1) - 1).bit_length() - 1
    above = reached >> goal
    above = goal + (above & -above).bit_length() - 1 if above else -1
    at = below if above < 0 or (below >= 0 and goal_distance(below, reach, wanted) <= goal_distance(above, reach, wanted)) else above
    taken: dict[int, int] = {}
    while at != reach:
        length, times = moves[first[at]]
        taken[length] = taken.get(length, 0) + times
        at -= length * times
    return taken


def goal_distance(at: int, reach: int, wanted: float) -> float:
    return abs(at - reach - wanted)


def fit_all(lengths: list[int], most: list[int], wanted: float, limit: int) -> dict[int, int] | None:
    """The selection nearest `wanted` of all there are, or None where they have more than `limit` different sums."""
    sums, parents = np.zeros(1, np.int64), []
    moves = _moves(lengths, [0] * len(lengths), most)
    for length, times in moves:
        more = sums + length * times
        new = more[~np.isin(more, sums, assume_unique=True)]
        parents.append(new)
        sums = np.union1d(sums, new)
        if len(sums) > limit:
            return None
    at = int(sums[np.lexsort((sums, np.abs(sums - wanted)))[0]])
    taken: dict[int, int] = {}
    for (length, times), new in zip(reversed(moves), reversed(parents), strict=True):
        k = np.searchsorted(new, at)
        if k < len(new) and new[k] == at:
            taken[length] = taken.get(length, 0) + times
            at -= length * times
    return taken


def plan_source(lengths: list[int], counts: list[int], target: float, reaches: tuple[int, ...] = REACHES, all_sums: int = ALL_SUMS) -> dict[int, int]:
    """length -> documents to take of it, from 0 to twice its count, with words as near the target as can be.

    Lengths are divided by their greatest common divisor. Where moves of up to a reach around the even
    share meet the target, that is the result. If none does, all selections are searched where they
    are few enough (few documents, however long); else the nearest sum of the last reach stands.
    The number of moves from one selection to a best one is below twice the greatest length, and
    their words add up to less than its square: with lengths below the root of the last reach (2,048
    words, after division) the result is a best one in any case, and with longer ones wherever the target is met.
    """
    known = sorted((n, c) for n, c in zip(lengths, counts, strict=True) if n > 0 and c > 0)
    if not known:
        return {}
    unit = math.gcd(*[n for n, _ in known])
    sizes, most = [n // unit for n, _ in known], [2 * c for _, c in known]
    wanted = min(target / unit, float(sum(n * m for n, m in zip(sizes, most, strict=True))))
    share = wanted / sum(n * m for n, m in zip(sizes, most, strict=True))
    even = [min(m, int(m * share)) for m in most]
    rest = wanted - sum(n * k for n, k in zip(sizes, even, strict=True))
    # the rounding of the even shares is made up for by the longest first, so that the fit is over a small rest
    for i in reversed(range(len(sizes))):
        k = min(most[i] - even[i], int(rest // sizes[i]))
        even[i], rest = even[i] + k, rest - k * sizes[i]
    best = None
    whole = sum(n * m for n, m in zip(sizes, most, strict=True))
    for reach in reaches:
        if rest + 1 > reach:
            continue
        moved = fit_moves(sizes, [-k for k in even], [m - k for m, k in zip(most, even, strict=True)], rest, reach)
        best = {n: k + moved.get(n, 0) for n, k in zip(sizes, even, strict=True)}
        if reach >= whole or abs(sum(n * k for n, k in best.items()) - wanted) <= 0.5:
            break
    else:
        found = fit_all(sizes, most, wanted, all_sums)
        if found is not None or best is None:
            best = found if found is not None else dict(zip(sizes, even, strict=True))
    return {n * unit: k for n, k in best.items() if k}


def source_targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """sources: no_source, source, source_size, a row for each. Adds target.

    Weights repeat over the sources in order of source, null last. A target is capped at `most`
    times its source; the water level is where capped and weighted targets add up to the budget.
    """
    by_name = Window.orderBy("no_source", "source")
    weighted = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    everything = Window.partitionBy()
    cap = F.col("source_size") * most
    by_fill = Window.orderBy(cap / F.col("weight"), "no_source", "source")
    filled = (
        weighted.withColumn("budget", F.sum("source_size").over(everything) * share)
        .withColumn("cap", cap)
        .withColumn("capped_before", F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("capped_before")) / F.col("weight_left"))
        .withColumn("open_level", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level")))
        .withColumn("water", F.first("open_level", ignorenulls=True).over(by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("water") * F.col("weight")))
    return filled.select("no_source", "source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    size: Column | None = None,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    slots: int = 256,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken; one row for each row of docs. With keep also kept, a struct of these columns of the row.

    docs: doc_id, source and (for the default size, its words) text; other columns but `keep` are not read.
    size defaults to the number of words of the whole text, however long, 0 for null texts. A null
    source is a source of its own, last in order. copies is 0, 1 or 2 and taken = copies * size; texts without words
    are taken 0 times. Repeated rows each count as a document; an empty table gives an empty mix.
    Equal input and seed give equal results: ties of the seeded hash go to the lesser doc_id, null
    first, and rows alike in both are alike. A length that very many documents of a source share is
    ranked in `slots` parts by hash. A source's plan is made from its different lengths alone.
    """
    size = F.size(split_words(F.col("text"))).cast("long") if size is None else size
    key = [F.col("source").isNull().alias("no_source"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")]
    sized = materialize(docs.select("doc_id", *key, size.alias("size"), *([F.struct(*keep).alias("kept")] if keep else [])).withColumn("h", F.xxhash64(F.lit(seed), "doc_id")), "sized")
    histogram = sized.groupBy("no_source", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    sources = histogram.groupBy("no_source", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sources, weights, share, most)

    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        taken = plan_source(rows["size"].tolist(), rows["n"].tolist(), float(rows["target"].iloc[0]))
        times = np.array([taken.get(int(n), 0) for n in rows["size"]], np.int64)
        return pd.DataFrame({
            "no_source": rows["no_source"], "source": rows["source"], "size": rows["size"],
            "base": times // rows["n"], "quota": times % rows["n"],
            "source_size": rows["source_size"], "target": rows["target"],
        })

    of_source = ["no_source", "source"]
    quotas = histogram.join(targets, of_source).groupBy(*of_source).applyInPandas(plan, "no_source boolean, source string, size long, base int, quota long, source_size long, target double")
    slotted = sized.withColumn("slot", F.pmod("h", F.lit(slots)))
    of_slot = [*of_source, "size", "slot"]
    before = Window.partitionBy(*of_source, "size").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = slotted.groupBy(*of_slot).agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    shares = counts.join(quotas, [*of_source, "size"]).drop("n")
    rank = F.row_number().over(Window.partitionBy(*of_slot).orderBy("h", "doc_id"))
    return (
        slotted.withColumn("rank", rank)
        .join(shares, of_slot)
        .withColumn("copies", F.col("base") + (F.col("before") + F.col("rank") <= F.col("quota")).cast("int"))
        .select("doc_id", F.when(~F.col("no_source"), F.col("source")).alias("source"), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *(["kept"] if keep else []))
    )


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(read_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies")
