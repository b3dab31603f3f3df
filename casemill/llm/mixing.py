"""Mixing sources to target weights by subset-sum budget fitting.

Each source gets a budget of words. Whole passes over the source use up most of it; what remains
must be met by a subset of its documents. Documents are counted by exact length, lengths are
taken in proportion to the budget, and bounded-knapsack dynamic programming over the lengths
fills the rest to the word if any subset can. Which documents of a length are taken is decided by
a seeded hash.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.shared import free_name
from casemill.session import staged

#: Weights of the sources in code point order, repeated.
WEIGHTS = (1, 2, 3)
#: No source's target, and no document's words in the mix, exceed so many times its size.
MOST_PASSES = 3
SEED = 20
#: Slices of the hash range in which the documents of one length are ranked.
SLICES = 256


def word_count(text):
    """Number of runs of characters other than the six ASCII white-space ones; 0 for a null."""
    marked = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "\x01")
    return F.coalesce(F.length(F.regexp_replace(marked, r"[^\x01]", "")), F.lit(0)).cast("long")


def reshare(sizes: list[int], weights: list[int], most: int = MOST_PASSES) -> list[float]:
    """Targets by weight; what a source can't take is shared among the others by weight.

    ``most`` must be at least 1; then the caps leave room for the total.
    """
    total = float(sum(sizes))
    cap = [most * float(s) for s in sizes]
    target = [0.0] * len(sizes)
    free = list(range(len(sizes)))
    left = total
    while free:
        weight = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / weight > cap[i]]
        if not over:
            for i in free:
                target[i] = left * weights[i] / weight
            break
        for i in over:
            target[i] = cap[i]
        left -= sum(cap[i] for i in over)
        free = [i for i in free if i not in over]
    return target


def fit_counts(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take so that their words come nearest to ``budget``.

    Lengths are taken in proportion first, then one by one from the longest, until what remains
    is below the longest length twice over; the rest is a bounded knapsack over the documents not
    yet taken. Its reachable sums are the bits of one integer for each length.
    """
    lengths = sorted((n for n in counts if n > 0), reverse=True)
    total = sum(n * counts[n] for n in lengths)
    if total == 0 or budget <= 0:
        return {}
    budget = min(budget, total)
    taken = {n: counts[n] * budget // total for n in lengths}
    rest = budget - sum(n * taken[n] for n in lengths)
    for n in lengths:
        if rest <= 2 * lengths[0]:
            break
        if taken[n] < counts[n] and n <= rest:
            more = min(counts[n] - taken[n], (rest - 2 * lengths[0]) // n + 1)
            taken[n] += more
            rest -= n * more
    best = _knapsack({n: counts[n] - taken[n] for n in lengths}, rest)
    return {n: taken[n] + best.get(n, 0) for n in lengths if taken[n] + best.get(n, 0)}


def _knapsack(counts: dict[int, int], budget: int) -> dict[int, int]:
    """Counts of each length whose sum is nearest to ``budget``, at most by one length above."""
    usable = [n for n in sorted(counts) if counts[n]]
    if not usable or budget <= 0:
        return {}
    bound = budget + usable[-1]
    mask = (1 << (bound + 1)) - 1
    reach = 1
    before: list[int] = []
    for n in usable:
        before.append(reach)
        left, step = min(counts[n], bound // n), 1
        while left:
            use = min(step, left)
            reach |= (reach << (n * use)) & mask
            left -= use
            step *= 2
        if (reach >> budget) & 1:
            break
    under = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> (budget + 1)
    over = budget + (above & -above).bit_length() if above else None
    total = over if over is not None and over - budget < budget - under else under
    chosen: dict[int, int] = {}
    for n, sums in zip(reversed(usable[: len(before)]), reversed(before), strict=True):
        k = 0
        while not (sums >> total) & 1:
            total -= n
            k += 1
        if k:
            chosen[n] = k
    return chosen


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target for each source; one row a source, gathered by the driver.

    Sources are few (a name per data provider) beside the documents.
    """
    rows = sizes.collect()
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    size = [int(r["source_size"]) for r in rows]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))]
    target = reshare(size, weights)
    return sizes.sparkSession.createDataFrame(
        [(r["source"], s, t) for r, s, t in zip(rows, size, target, strict=True)],
        "source string, source_size long, target double",
    )


def _draw(seed: int):
    return F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.col("text").cast("string"))


def mix_sources(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """How much of each document the mix takes.

    Returns each row's doc_id, size, source, source_size, target, ``draw`` (its seeded hash),
    ``passes`` (how often the document is in the mix) and taken (size x passes). A null text has
    size 0; null sources are one source, the last; rows that repeat a doc_id count each, also those
    without one. The same seed gives the same mix; of documents that tie in the seeded hash the
    smaller doc_id is taken. Words of a text of any length are counted whole. An empty table gives
    an empty result; other columns are ignored, whatever their names.
    """
    counted = docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        word_count(F.col("text")).alias("size"),
        _draw(seed).alias("draw"),
    )
    counted = staged(counted, "mix-sizes")
    lengths = staged(
        counted.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-lengths"
    )
    targets = source_targets(
        lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    )

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        whole = int(min(MOST_PASSES, target // size)) if size else 0
        budget = round(target) - whole * size if whole < MOST_PASSES else 0
        counts = dict(zip(pdf["size"].tolist(), pdf["n"].tolist(), strict=True))
        chosen = fit_counts(counts, budget)
        out = pdf[["source", "size", "source_size", "target"]].copy()
        out["whole"] = whole
        out["quota"] = [chosen.get(n, 0) for n in pdf["size"].tolist()]
        return out

    plans = (
        lengths.join(targets, lengths.source.eqNullSafe(targets.source))
        .select(lengths.source, "size", "n", "source_size", "target")
        .groupBy("source")
        .applyInPandas(
            plan,
            "source string, size long, source_size long, target double, whole long, quota long",
        )
    )
    plans = staged(plans, "mix-plan")

    # The quota of a length goes to the documents with the smallest hashes. Slices of the hash
    # range are counted first, so only the slice in which the quota ends has to be ranked.
    low = F.lit(-(2**63)).cast("double")
    slice_of = F.least(
        F.floor((F.col("draw").cast("double") - low) / (2**64 / SLICES)), F.lit(SLICES - 1)
    )
    sliced = counted.withColumn("slice", slice_of)
    key = ["source", "size"]
    per_slice = sliced.groupBy(*key, "slice").agg(F.count("*").alias("in_slice"))
    earlier = Window.partitionBy(*key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = per_slice.withColumn(
        "before", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0))
    )
    p, q = plans.alias("p"), per_slice.alias("q")
    decided = p.join(
        q, F.col("p.source").eqNullSafe(F.col("q.source")) & (F.col("p.size") == F.col("q.size"))
    ).select(
        "p.source", "p.size", "source_size", "target", "whole", "slice",
        F.greatest(
            F.least(F.col("quota") - F.col("before"), F.col("in_slice")), F.lit(0)
        ).alias("slice_quota"),
        "in_slice",
    )
    s, d = sliced.alias("s"), decided.alias("d")
    joined = s.join(
        d,
        F.col("s.source").eqNullSafe(F.col("d.source"))
        & (F.col("s.size") == F.col("d.size"))
        & (F.col("s.slice") == F.col("d.slice")),
    ).select(
        "s.doc_id", "s.source", "s.size", "s.draw", "s.slice",
        "source_size", "target", "whole", "slice_quota", "in_slice",
    )
    split = (F.col("slice_quota") > 0) & (F.col("slice_quota") < F.col("in_slice"))
    order = Window.partitionBy("source", "size", "slice").orderBy("draw", "doc_id")
    ranked = joined.filter(split).withColumn("rank", F.row_number().over(order))
    settled = joined.filter(~split).withColumn("rank", F.lit(1))
    return settled.unionByName(ranked).select(
        "doc_id",
        "size",
        "source",
        "source_size",
        "target",
        "draw",
        (F.col("whole") + (F.col("rank") <= F.col("slice_quota")).cast("long")).alias("passes"),
        (
            F.col("size")
            * (F.col("whole") + (F.col("rank") <= F.col("slice_quota")).cast("long"))
        ).alias("taken"),
    )


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it.

    The columns stay as they are, whatever their names; an empty table stays empty.
    """
    names = ("mix_id", "mix_draw", "mix_passes", "mix_row", "mix_pass")
    own, draw, passes, row, turn = (free_name(docs, n) for n in names)
    key = [own, draw]
    taken = (
        mix_sources(docs, seed)
        .groupBy(F.coalesce("doc_id", F.lit(-1)).alias(own), F.col("draw").alias(draw))
        .agg(F.sum("passes").alias(passes))
        .filter(F.col(passes) > 0)
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return (
        docs.withColumns(
            {own: F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), draw: _draw(seed)}
        )
        .join(taken, key)
        # Rows that are equal in id and text share their passes.
        .withColumn(row, F.row_number().over(Window.partitionBy(key).orderBy(draw)))
        .filter(F.col(row) == 1)
        .withColumn(turn, F.explode(F.sequence(F.lit(1).cast("long"), passes)))
        .select(*columns)
    )
