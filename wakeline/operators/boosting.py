"""Gradient boosting of all classes together, on MLlib's regression trees.

A round fits one regression tree per class to the gradients of the loss at the
margins so far. With the second derivative h as weight and -gradient / h as
label, a leaf's mean is its Newton step and the split gain is that of second
order boosting. Margins are kept with the rows and only moved by new trees, so a
round costs the same however many came before it, and boosting can go on later.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from wakeline.functions import scalars as S
from wakeline.operators.skew import settle

# Rounds after which the margins are written down; their trees are applied on reading until then.
EVERY = 20
LEAST_WEIGHT = 1e-16
# Steps in which the share of rows that a tree sees can be set.
DRAWS = 1 << 20
CLASSES = tuple(S.CLASSES)
MARGINS = tuple(f"_m{i}" for i in range(len(CLASSES)))


@dataclass(frozen=True)
class Boosted:
    """Trees by round and class, of which the first `rounds` rounds count.

    `f1` has the held-out macro F1 after every round, if boosting looked at it.
    """

    trees: list
    start: tuple
    step: float
    objective: str
    f1: tuple
    rounds: int

    def first(self, rounds: int) -> Boosted:
        return replace(self, rounds=rounds)

    def importances(self) -> np.ndarray:
        """The shares of the features in the gains of the counted trees, summed over the classes."""
        total = np.zeros(self.trees[0][0].numFeatures)
        for c in range(len(CLASSES)):
            own = _sum_of([r[c] for r in self.trees[:self.rounds]], self.step).featureImportances.toArray()
            total[:len(own)] += own  # as long as the last feature in use
        return total


def _sum_of(trees: list, step: float) -> GBTRegressionModel:
    """The model that adds up `step` times each tree's prediction."""
    from pyspark import SparkContext
    sc = SparkContext.getOrCreate()
    regression = sc._jvm.org.apache.spark.ml.regression
    parts = sc._gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    weights = sc._gateway.new_array(sc._gateway.jvm.double, len(trees))
    for i, tree in enumerate(trees):
        parts[i], weights[i] = tree._java_obj, step
    return GBTRegressionModel(regression.GBTRegressionModel(f"sum_{id(trees):x}", parts, weights)).setFeaturesCol("x")


def _moved(table: DataFrame, rounds: list, step: float) -> DataFrame:
    """The margins of (x, margins, ...) after these rounds of trees."""
    for c, margin in enumerate(MARGINS):
        if rounds:
            summed = _sum_of([r[c] for r in rounds], step).setPredictionCol("_add").transform(table)
            table = summed.withColumn(margin, F.col(margin) + F.col("_add")).drop("_add")
    return table


def probabilities(objective: str) -> list[Column]:
    """The class probabilities at the margins: 'softmax' over all, or 'each' class against the rest."""
    if objective == "each":
        return [F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col(m))) for m in MARGINS]
    if objective != "softmax":
        raise ValueError(f"unknown objective {objective!r}")
    top = F.greatest(*MARGINS)
    total = reduce(lambda a, b: a + b, [F.exp(F.col(m) - top) for m in MARGINS])
    return [F.exp(F.col(m) - top) / total for m in MARGINS]


def _with_targets(table: DataFrame, objective: str) -> DataFrame:
    """Adds the label `_z<class>` and weight `_h<class>` of every class's next tree."""
    k = len(CLASSES)
    factor = F.lit(k / (k - 1) if objective == "softmax" else 1.0)
    table = table.withColumns({f"_p{c}": p for c, p in enumerate(probabilities(objective))})
    table = table.withColumns({f"_h{c}": factor * F.greatest(F.col(f"_p{c}") * (1 - F.col(f"_p{c}")), F.lit(LEAST_WEIGHT))
                               for c in range(k)})
    return table.withColumns({f"_z{c}": ((F.col("type") == name).cast("double") - F.col(f"_p{c}")) / F.col(f"_h{c}")
                              for c, name in enumerate(CLASSES)})


def _start(train: DataFrame, objective: str) -> tuple:
    """Margins that give every row the classes' shares."""
    counts = {r["type"]: r["count"] for r in train.groupBy("type").count().collect()}
    total = sum(counts.values())
    shares = [min(max(counts.get(c, 0) / max(total, 1), 1e-15), 1 - 1e-15) for c in CLASSES]
    return tuple(float(np.log(p) if objective == "softmax" else np.log(p / (1 - p))) for p in shares)


def _macro_f1(held: DataFrame) -> float:
    """Macro F1 of (type, margins), over the classes that occur or are guessed."""
    top = F.greatest(*MARGINS)
    guess = F.coalesce(*[F.when(F.col(m) == top, F.lit(c)) for m, c in zip(MARGINS, CLASSES)])
    rows = held.groupBy("type", guess.alias("guess")).count().collect()  # classes^2 at most
    hits = {c: sum(r["count"] for r in rows if r["type"] == r["guess"] == c) for c in CLASSES}
    either = {c: sum(r["count"] * ((r["type"] == c) + (r["guess"] == c)) for r in rows) for c in CLASSES}
    scores = [2 * hits[c] / either[c] for c in CLASSES if either[c]]
    return float(np.mean(scores)) if scores else -1.0


def boost(table: DataFrame, params, bins: int, so_far: Boosted | None = None) -> Boosted:
    """Boosts on the rows of (id, x, type, held) that are not held, up to params.rounds rounds in all.

    `table` should be a written table. With params.patience boosting ends when
    the macro F1 of the held rows has not risen for so many rounds, and the
    first best round counts. `so_far` is gone on from: its trees are kept, and
    the result is the same as without a break, while MLlib takes its split
    points from all rows (it samples them beyond bins^2). The rows of a tree
    are drawn by a hash of their id.
    """
    from wakeline.operators.model import best_round
    train = table.filter("NOT held")
    start = so_far.start if so_far else _start(train, params.objective)
    trees, f1 = (list(so_far.trees), list(so_far.f1)) if so_far else ([], [])
    base = table.select("id", "x", "type", "held", *[F.lit(v).alias(m) for v, m in zip(start, MARGINS)])
    base, recent = settle(_moved(base, trees, params.step)), []

    def grow(rows: DataFrame, c: int):
        seed = params.seed + len(trees) * len(CLASSES) + c
        drawn = rows.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(DRAWS)) < int(params.sample * DRAWS))
        forest = RandomForestRegressor(
            featuresCol="x", labelCol=f"_z{c}", weightCol=f"_h{c}", numTrees=1, bootstrap=False, maxDepth=params.depth,
            featureSubsetStrategy=str(params.features), minInstancesPerNode=params.min_rows, maxBins=bins, seed=seed)
        return forest.fit(drawn).trees[0]

    with ThreadPoolExecutor(len(CLASSES)) as pool:
        while len(trees) < params.rounds and not (params.patience and f1 and best_round(f1, params.patience)[1]):
            rows = _with_targets(_moved(base, recent, params.step).filter("NOT held"), params.objective).persist()
            grown = list(pool.map(lambda c: grow(rows, c), range(len(CLASSES))))
            rows.unpersist()
            trees.append(grown)
            recent.append(grown)
            if len(recent) >= EVERY:
                base, recent = settle(_moved(base, recent, params.step)), []
            if params.patience:
                f1.append(_macro_f1(_moved(base, recent, params.step).filter("held")))
    rounds = best_round(f1, params.patience)[0] if params.patience and f1 else len(trees)
    return Boosted(trees, start, params.step, params.objective, tuple(f1), rounds)


def score(boosted: Boosted, table: DataFrame, names) -> DataFrame:
    """The class probabilities of the (x, ...) rows in place of x, under `names`, scaled to sum 1."""
    keep = [c for c in table.columns if c != "x"]
    rows = table.select("*", *[F.lit(v).alias(m) for v, m in zip(boosted.start, MARGINS)])
    rows = _moved(rows, boosted.trees[:boosted.rounds], boosted.step)
    rows = rows.select(*keep, *[p.alias(f"_p{c}") for c, p in enumerate(probabilities(boosted.objective))])
    total = reduce(lambda a, b: a + b, [F.col(f"_p{c}") for c in range(len(CLASSES))])
    return rows.select(*keep, *[S.safe_ratio(F.col(f"_p{c}"), total).alias(n) for c, n in enumerate(names)])
