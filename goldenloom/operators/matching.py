"""A matcher learned without labels: Fellegi-Sunter weights by expectation-maximisation.

Each pair is compared field by field; a comparison falls into a level, or is missing. Pairs with equal levels are one
pattern, and there are at most as many patterns as products of levels: their counts, one aggregate over all pairs, are all
that is learned from. The weights go back to the pairs as an expression."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenloom.sources import files


@dataclass(frozen=True)
class Comparison:
    """score: a similarity from 0 to 1, null where a side is missing; cuts: the least scores of levels 1, 2 and so on."""

    name: str
    score: Column
    cuts: tuple[float, ...] = (0.7, 0.9)

    def level(self, score: Column) -> Column:
        """Of a worked out score: 0 for the least alike; -1 for missing."""
        return F.when(score.isNull(), F.lit(-1)).otherwise(sum((F.when(score >= cut, 1).otherwise(0) for cut in self.cuts), F.lit(0)))


@dataclass(frozen=True)
class Model:
    """share: of matches among the pairs; m and u: by field, the chances of its levels for matches and others."""

    share: float
    m: tuple[tuple[float, ...], ...]
    u: tuple[tuple[float, ...], ...]

    def probability(self, levels: tuple[int, ...]) -> float:
        """That a pair of these levels is a match; missing fields say nothing."""
        odds = math.log(self.share) - math.log(1 - self.share)
        odds += sum(math.log(m[k]) - math.log(u[k]) for m, u, k in zip(self.m, self.u, levels) if k >= 0)
        return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


def learn(patterns: dict[tuple[int, ...], int], levels: list[int], share: float = 0.1, rounds: int = 200, close: float = 1e-9) -> Model:
    """patterns: counts by levels (-1 missing); levels: by field how many there are. From a start where matches lean to
    high levels, chances and weights take turns until none moves by `close`; a level's chance is kept off zero by half a
    pair, so that a pattern not seen is improbable, not impossible."""
    lean = [[2.0**k for k in range(n)] for n in levels]
    m = [[x / sum(f) for x in f] for f in lean]
    u = [[x / sum(f) for x in f[::-1]] for f in lean]
    total = sum(patterns.values())
    if not total:
        return Model(share, tuple(map(tuple, m)), tuple(map(tuple, u)))
    for _ in range(rounds):
        model = Model(share, tuple(map(tuple, m)), tuple(map(tuple, u)))
        p = {levels_: model.probability(levels_) for levels_ in patterns}
        new_share = min(1 - 1e-9, max(1e-9, sum(n * p[k] for k, n in patterns.items()) / total))
        new_m, new_u = [], []
        for f, n_levels in enumerate(levels):
            for out, weight in ((new_m, lambda k: p[k]), (new_u, lambda k: 1 - p[k])):
                sums = [0.5] * n_levels
                for k, n in patterns.items():
                    if k[f] >= 0:
                        sums[k[f]] += n * weight(k)
                out.append([x / sum(sums) for x in sums])
        moved = max(abs(a - b) for old, new in ((m, new_m), (u, new_u)) for x, y in zip(old, new) for a, b in zip(x, y))
        moved, share, m, u = max(moved, abs(share - new_share)), new_share, new_m, new_u
        if moved < close:
            break
    return Model(share, tuple(map(tuple, m)), tuple(map(tuple, u)))


def threshold(patterns: dict[tuple[int, ...], int], model: Model, recall_weight: float = 1.0) -> float:
    """The least probability to accept: where expected recall and precision, recall weighted by `recall_weight`, are best
    together. With the pairs by falling probability, expected matches are its running sum."""
    ranked = sorted(((model.probability(k), n) for k, n in patterns.items()), reverse=True)
    expected = sum(p * n for p, n in ranked)
    best, least, found, taken = -1.0, 1.0, 0.0, 0
    for at, (p, n) in enumerate(ranked):
        found, taken = found + p * n, taken + n
        if at + 1 < len(ranked) and ranked[at + 1][0] == p:
            continue
        recall, precision = found / expected if expected else 0.0, found / taken
        score = recall * precision / (recall + recall_weight**2 * precision) if recall + precision else 0.0
        if score > best:
            best, least = score, p
    return least


def match(pairs: DataFrame, comparisons: list[Comparison], recall_weight: float = 1.0) -> tuple[DataFrame, Model]:
    """The pairs that the learned model accepts, with their `probability`, and the model. The driver holds one count per
    pattern, at most the product of the fields' levels and missing marks, whatever the number of pairs."""
    levels = [len(c.cuts) + 1 for c in comparisons]
    names = [f"_level_{k}" for k in range(len(comparisons))]
    # Scores are columns first, each worked out once; inside a lambda what they share would be worked out again and again.
    scored = pairs.withColumns({n: c.score for n, c in zip(names, comparisons)})
    leveled = files.stored(scored.withColumns({n: c.level(F.col(n)) for n, c in zip(names, comparisons)}))
    patterns = {tuple(r[n] for n in names): r["_n"] for r in leveled.groupBy(*names).agg(F.count("*").alias("_n")).collect()}
    model = learn(patterns, levels)
    least = threshold(patterns, model, recall_weight)
    odds = F.lit(math.log(model.share) - math.log(1 - model.share))
    for name, m, u in zip(names, model.m, model.u):
        weights = F.array(*(F.lit(math.log(a) - math.log(b)) for a, b in zip(m, u)))
        odds = odds + F.coalesce(F.get(weights, F.when(F.col(name) >= 0, F.col(name))), F.lit(0.0))
    scored = leveled.withColumn("probability", 1 / (1 + F.exp(-odds))).drop(*names)
    return scored.where(F.col("probability") >= least - 1e-12), model
