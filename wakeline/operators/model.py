"""Cross-validated boosted trees over feature tables."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from wakeline.functions import scalars as S
from wakeline.operators import boosting
from wakeline.operators.metrics import PROBABILITIES
from wakeline.operators.skew import settle

# Trees have no missing values; these stand below and above every real feature.
MISSING, HUGE = -1e18, 1e17


@dataclass(frozen=True)
class TreeParams:
    """Boosting settings. With `patience` boosting ends when the held-out macro F1 has not
    risen for that many rounds, and the best round counts; without it all rounds count.

    `objective` is 'softmax' for all classes together, 'each' for each class against the
    rest with rounds in step (see boosting), or 'rest' for MLlib's own boosted classifier
    per class.
    """

    rounds: int
    step: float
    depth: int
    features: float
    sample: float
    min_rows: int = 20
    seed: int = 1
    patience: int = 0
    bins: int = 255
    objective: str = "rest"


# The three members' learning rate, leaf budget (63, 63 and 35
# leaves as depth), feature and row shares, leaf size, round limit and patience.
MEMBER_PARAMS = {
    "a": TreeParams(3000, 0.05, 6, 0.8, 0.8, patience=100, objective="softmax"),
    "b": TreeParams(5000, 0.05, 6, 0.8, 1.0, patience=100, objective="softmax"),
    "c": TreeParams(3000, 0.06, 5, 0.7, 0.9, patience=300, objective="each"),
}


def assign_folds(ids: DataFrame, k: int = 5, seed: int = 1996, label: str | None = None) -> DataFrame:
    """Adds `fold` 0..k-1 by rank of a hash of the id, so fold sizes differ by at most one.

    With `label` the ranks run within each class. Ranks come from 4096 hash
    ranges and their running totals; no window spans the whole table.
    """
    part = [] if label is None else [label]
    keyed = (ids.withColumn("_key", F.md5(F.concat_ws("_", F.col("id").cast("string"), F.lit(str(seed)))))
             .withColumn("_range", F.substring("_key", 1, 3)))
    earlier = Window.orderBy("_range") if label is None else Window.partitionBy(label).orderBy("_range")
    starts = (keyed.groupBy(*part, "_range").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_start", F.coalesce(
                  F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("_n"))
    # At most 4096 rows per class.
    within = Window.partitionBy(*part, "_range").orderBy("_key", "id")
    ranked = keyed.withColumn("_rank", F.row_number().over(within) - 1)
    return (ranked.join(F.broadcast(starts), [*part, "_range"])
            .withColumn("fold", F.pmod(F.col("_start") + F.col("_rank"), F.lit(k)).cast("int"))
            .select(*ids.columns, "fold"))


def feature_columns(table: DataFrame, skip=("id", "type", "label", "fold")) -> list[str]:
    return [c for c in table.columns if c not in skip]


def drop_by_substring(table: DataFrame, parts) -> DataFrame:
    """Drop every column whose name contains one of `parts`."""
    return table.drop(*[c for c in table.columns if any(p in c for p in parts)])


def with_missing_flags(table: DataFrame, columns, suffix: str = "_missing") -> DataFrame:
    """Adds for each column whether its value is missing, 1.0 or 0.0; the trees see only a stand-in for it."""
    def flag(c):
        v = F.col(f"`{c}`").cast("double")
        return F.when(v.isNull() | F.isnan(v), 1.0).otherwise(0.0)
    return table.withColumns({f"{c}{suffix}": flag(c) for c in columns})


def assemble(table: DataFrame, columns, keep, categorical=()) -> DataFrame:
    """(keep..., x): one vector column; missing and infinite values get stand-ins.

    The trees split `categorical` columns by category, missing being one of them.
    """
    if categorical:
        names = list(categorical)
        indexed = [f"_index_{c}" for c in names]
        table = (StringIndexer(inputCols=names, outputCols=indexed, handleInvalid="keep")
                 .fit(table).transform(table))
        numbers = [c for c in columns if c not in names]
        rest = assemble(table, numbers, [*keep, *indexed])
        joined = VectorAssembler(inputCols=["x", *indexed], outputCol="_all").transform(rest)
        return joined.select(*keep, "_all").withColumnRenamed("_all", "x")
    def real(c):
        v = F.col(f"`{c}`").cast("double")
        return (F.when(v.isNull() | F.isnan(v), F.lit(MISSING)).when(v > HUGE, F.lit(HUGE))
                .when(v < -HUGE, F.lit(-HUGE)).otherwise(v).alias(c))
    filled = table.select(*keep, *[real(c) for c in columns])
    return VectorAssembler(inputCols=list(columns), outputCol="x").transform(filled).select(*keep, "x")


def _bins(train: DataFrame, least: int) -> int:
    """Bins per column: `least`, or as many as the largest categorical column has categories."""
    attributes = train.schema["x"].metadata.get("ml_attr", {}).get("attrs", {})
    return max([least, *(len(a.get("vals", ())) for a in attributes.get("nominal", ()))])


def fit_rest(train: DataFrame, params: TreeParams) -> list:
    """One binary boosted model per class from (x, type)."""
    models = []
    for c in S.CLASSES:
        gbt = GBTClassifier(
            featuresCol="x", labelCol="y", maxIter=params.rounds, stepSize=params.step,
            maxDepth=params.depth, subsamplingRate=params.sample, seed=params.seed,
            featureSubsetStrategy=str(params.features), minInstancesPerNode=params.min_rows,
            maxBins=_bins(train, params.bins))
        models.append(gbt.fit(train.withColumn("y", (F.col("type") == c).cast("double"))))
    return models


@dataclass(frozen=True)
class Ensemble:
    """One boosted model per class, of which the first `rounds` trees count."""

    models: list
    rounds: int

    def importances(self) -> np.ndarray:
        """The shares of the features in the gains of the counted trees, summed over the classes."""
        total = 0
        for m in self.models:
            own = sum(t.featureImportances.toArray() for t in m.trees[:self.rounds])
            total = total + own / max(own.sum(), 1e-300)
        return total


def _leaves(m) -> np.ndarray:
    """What each leaf of each tree adds to the margin, leaves from left to right: (trees, leaves)."""
    rows = []
    for tree, weight in zip(m.trees, m.treeWeights):
        values = re.findall(r"Predict: (\S+)", tree.toDebugString)
        rows.append([weight * float(v) for v in values])
    table = np.zeros((len(rows), max(map(len, rows))))
    for at, row in enumerate(rows):
        table[at, :len(row)] = row
    return table


def _with_leaves(models, table: DataFrame) -> DataFrame:
    """Adds to (x, ...) the leaf that each row falls into, by class and tree, in place of x."""
    keep = [c for c in table.columns if c != "x"]
    out = table
    for i, m in enumerate(models):
        out = (m.copy().setLeafCol(f"_leaf{i}").transform(out)
               .drop("rawPrediction", "probability", "prediction"))
    return out.select(*keep, *[vector_to_array(f"_leaf{i}", "float32").alias(f"_leaf{i}") for i in range(len(models))])


def f1_by_round(models, valid: DataFrame) -> np.ndarray:
    """The macro F1 on (x, type) of the first tree, the first two, and so on."""
    tables, classes = [_leaves(m) for m in models], list(S.CLASSES)
    rounds = min(len(t) for t in tables)

    def count(batches):
        at = np.arange(rounds)
        for b in batches:
            counts = np.zeros((rounds, len(classes), len(classes)), dtype=np.int64)
            for start in range(0, len(b), 100):
                rows = b.iloc[start:start + 100]
                margins = np.stack([np.cumsum(t[at, np.stack(rows[f"_leaf{i}"].to_list())[:, :rounds].astype(int)], axis=1)
                                    for i, t in enumerate(tables)], axis=2)
                guessed = margins.argmax(axis=2)
                for actual, row in zip(rows["type"], guessed):
                    counts[at, classes.index(actual), row] += 1
            r, actual, guess = np.nonzero(counts)
            yield pd.DataFrame({"r": r, "actual": actual, "guess": guess, "n": counts[r, actual, guess]})

    sums = (_with_leaves(models, valid.select("x", "type")).mapInPandas(count, "r int, actual int, guess int, n long")
            .groupBy("r", "actual", "guess").agg(F.sum("n").alias("n")).collect())  # rounds x classes^2 at most
    counts = np.zeros((rounds, len(classes), len(classes)))
    for r in sums:
        counts[r["r"], r["actual"], r["guess"]] = r["n"]
    hits = np.einsum("rcc->rc", counts)
    either = counts.sum(axis=1) + counts.sum(axis=2)
    f1 = np.where(either > 0, 2 * hits / np.maximum(either, 1), np.nan)
    return np.nanmean(f1, axis=1) if sums else np.full(rounds, -1.0)


def best_round(f1, patience: int) -> tuple[int, bool]:
    """The number of rounds to keep, the first best, and whether patience ran out before the end."""
    best = 0
    for r in range(1, len(f1)):
        if f1[r] > f1[best]:
            best = r
        elif r - best >= patience:
            return best + 1, True
    return best + 1, False


def _normalised(df: DataFrame) -> DataFrame:
    total = reduce(lambda a, b: a + b, [F.col(f"_{p}") for p in PROBABILITIES])
    return df.select("*", *[S.safe_ratio(F.col(f"_{p}"), total).alias(p) for p in PROBABILITIES]) \
        .drop(*[f"_{p}" for p in PROBABILITIES])


def score_rest(ensemble: Ensemble, table: DataFrame) -> DataFrame:
    """Class probabilities of the (x) rows, scaled to sum 1."""
    keep = [c for c in table.columns if c != "x"]
    tables, rounds = [_leaves(m)[:ensemble.rounds] for m in ensemble.models], ensemble.rounds
    names = [f"_{p}" for p in PROBABILITIES]

    def score(batches):
        at = np.arange(rounds)
        for b in batches:
            out = b[keep].copy()
            for i, (t, name) in enumerate(zip(tables, names)):
                sums = [t[at, np.asarray(leaf)[:rounds].astype(int)].sum() for leaf in b[f"_leaf{i}"]]
                out[name] = 1.0 / (1.0 + np.exp(-2.0 * np.array(sums, dtype=float)))
            yield out

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema if f.name != "x"]
                       + [f"`{n}` double" for n in names])
    return _normalised(_with_leaves(ensemble.models, table).mapInPandas(score, schema))


def fit_best(train: DataFrame, valid: DataFrame, params: TreeParams) -> Ensemble:
    """The ensemble of the round with the best macro F1 on the held-out rows.

    A fit contains all shorter ones, so its prefixes are scored instead of
    fitting again; the number of rounds is doubled until patience runs out.
    """
    if not params.patience:
        return Ensemble(fit_rest(train, params), params.rounds)
    rounds = min(params.rounds, 2 * params.patience)
    while True:
        models = fit_rest(train, replace(params, rounds=rounds))
        best, ended = best_round(f1_by_round(models, valid), params.patience)
        if ended or rounds >= params.rounds:
            return Ensemble(models, best)
        rounds = min(params.rounds, 2 * rounds)


@dataclass(frozen=True)
class CrossValidated:
    oof: DataFrame         # id, type, fold, p_<class>... of every labelled track
    scores: DataFrame      # id, p_<class>... of the unlabelled tracks, mean over the folds
    importance: DataFrame  # feature, importance, fold


# Folds that are fitted at the same time; their jobs share the cluster.
SIDE_BY_SIDE = 5


def cross_validate(table: DataFrame, params: TreeParams, k: int = 5, seed: int = 1996,
                   stratified: bool = False, drop=(), categorical=(), side_by_side: int = SIDE_BY_SIDE,
                   flags: bool = False) -> CrossValidated:
    """Fit every fold on the others, score its held-out tracks and all unlabelled ones.

    `flags` adds a column for each number that says whether it is missing.

    The vectors are written once for all folds, of which `side_by_side` are
    fitted at a time, each tree on a scheduler thread of its own.
    """
    from wakeline.sources.tracks import labelled, unlabelled
    table = drop_by_substring(table, drop)
    columns = [c for c in feature_columns(table) if c not in categorical]
    if flags:
        table = with_missing_flags(table, columns)
        columns += [f"{c}_missing" for c in columns]
    ready = settle(assemble(table, [*columns, *categorical], ["id", "type"], categorical))
    columns += list(categorical)
    folds = assign_folds(labelled(ready.select("id", "type")), k, seed, "type" if stratified else None)
    known = settle(labelled(ready).join(folds.select("id", "fold"), "id"))
    test = unlabelled(ready).select("id", "x")
    bins = _bins(known, params.bins)

    def fit(f: int):
        held = known.filter(F.col("fold") == f)
        if params.objective == "rest":
            model, score = fit_best(known.filter(F.col("fold") != f), held, params), score_rest
        else:
            model = boosting.boost(known.withColumn("held", F.col("fold") == f), params, bins)
            score = lambda m, rows: boosting.score(m, rows, PROBABILITIES)
        gains = [(c, float(g), f) for c, g in zip(columns, model.importances())]
        return settle(score(model, held)), settle(score(model, test)), gains

    with ThreadPoolExecutor(side_by_side) as pool:
        oof, scores, gains = zip(*pool.map(fit, range(k)))
    stack = lambda parts: reduce(DataFrame.unionByName, parts)
    mean = stack(scores).groupBy("id").agg(*[F.avg(p).alias(p) for p in PROBABILITIES])
    rows = table.sparkSession.createDataFrame([g for x in gains for g in x], "feature string, importance double, fold int")
    return CrossValidated(stack(oof), mean, rows)
