"""Joint boosting against a plain replay, and going on where it stopped."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from wakeline.functions import scalars as S
from wakeline.operators import boosting, metrics, model

CLASSES = list(S.CLASSES)


def table(spark, n=200, columns=3, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, columns)), 6)
    y = (x[:, 0] + 0.3 * rng.normal(size=n) > 0.5).astype(int) + (x[:, 1] > 0.4)
    rows = [(i, CLASSES[c], *map(float, r)) for i, (c, r) in enumerate(zip(y, x))]
    names = [f"f{i}" for i in range(columns)]
    df = spark.createDataFrame(rows, "id bigint, type string, " + ", ".join(f"{c} double" for c in names))
    return VectorAssembler(inputCols=names, outputCol="x").transform(df).select("id", "type", "x"), x, y


def plain_tree(x, z, h, depth):
    """Predictions of the tree with the largest weighted variance reduction, exhaustively."""
    value = (h * z).sum() / h.sum()
    best = None
    if depth:
        for j in range(x.shape[1]):
            order = np.argsort(x[:, j], kind="stable")
            w, s = np.cumsum(h[order]), np.cumsum((h * z)[order])
            cut = np.flatnonzero(np.diff(x[order, j]) > 0)
            gain = s[cut] ** 2 / w[cut] + (s[-1] - s[cut]) ** 2 / (w[-1] - w[cut])
            if len(cut) and (best is None or gain.max() > best[0]):
                at = cut[gain.argmax()]
                best = gain.max(), j, (x[order[at], j] + x[order[at + 1], j]) / 2
    if best is None:
        return np.full(len(x), value)
    left = x[:, best[1]] <= best[2]
    out = np.empty(len(x))
    for side in (left, ~left):
        out[side] = plain_tree(x[side], z[side], h[side], depth - 1)
    return out


def replay(x, y, params):
    """Class probabilities after all rounds, and each round's margins."""
    hot = np.eye(3)[y]
    share = hot.mean(axis=0)
    softmax = params.objective == "softmax"
    m = np.tile(np.log(share) if softmax else np.log(share / (1 - share)), (len(x), 1))

    def p():
        if not softmax:
            return 1 / (1 + np.exp(-m))
        e = np.exp(m - m.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    for _ in range(params.rounds):
        now = p()
        h = (1.5 if softmax else 1.0) * now * (1 - now)
        m = m + params.step * np.stack([plain_tree(x, (hot - now)[:, c] / h[:, c], h[:, c], params.depth) for c in range(3)], axis=1)
    now = p()
    return now / now.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("objective", ["softmax", "each"])
def test_against_a_replay(spark, objective, monkeypatch):
    monkeypatch.setattr(boosting, "EVERY", 2)  # margins are written down in between
    rows, x, y = table(spark)
    params = model.TreeParams(rounds=5, step=0.3, depth=2, features=1.0, sample=1.0, min_rows=1, objective=objective)
    fitted = boosting.boost(rows.withColumn("held", F.lit(False)), params, 255)
    got = boosting.score(fitted, rows.select("id", "x"), metrics.PROBABILITIES).orderBy("id").toPandas()
    np.testing.assert_allclose(got[list(metrics.PROBABILITIES)].to_numpy(), replay(x, y, params), atol=1e-9)
    assert fitted.importances().sum() == pytest.approx(3) and len(fitted.trees) == 5


def test_going_on_gives_the_same_trees(spark):
    rows, _, _ = table(spark, 120)
    held = rows.withColumn("held", F.col("id") % 4 == 0)
    params = model.TreeParams(rounds=5, step=0.2, depth=2, features=0.7, sample=0.8, min_rows=2, patience=9, objective="softmax")
    straight = boosting.boost(held, params, 64)
    first = boosting.boost(held, model.replace(params, rounds=2), 64)
    resumed = boosting.boost(held, params, 64, first)
    assert resumed.f1 == pytest.approx(straight.f1) and len(first.f1) == 2
    scores = [boosting.score(b.first(5), rows.select("id", "x"), metrics.PROBABILITIES).orderBy("id").toPandas() for b in (straight, resumed)]
    np.testing.assert_allclose(scores[0], scores[1], atol=1e-12)


def test_patience_ends_boosting(spark):
    """Noise: as many rounds are fitted as count, and patience on top; f1 is that of the scores."""
    rows, _, _ = table(spark, 90, seed=3)
    rows = rows.withColumn("type", F.element_at(F.array(*[F.lit(c) for c in CLASSES]), (F.crc32(F.col("id").cast("string")) % 3 + 1).cast("int")))
    held = rows.withColumn("held", F.col("id") % 3 == 0)
    params = model.TreeParams(rounds=40, step=0.3, depth=2, features=1.0, sample=1.0, min_rows=1, patience=2, objective="softmax")
    fitted = boosting.boost(held, params, 32)
    assert len(fitted.trees) == fitted.rounds + 2 < 40
    scored = boosting.score(fitted, held.filter("held").select("id", "type", "x"), metrics.PROBABILITIES)
    f1 = metrics.macro_f1(metrics.with_prediction(scored).withColumn("label", F.col("type"))).first()["macro_f1"]
    assert f1 == pytest.approx(fitted.f1[fitted.rounds - 1])


def test_folds_side_by_side(spark):
    rows, x, _ = table(spark, 90)
    wide = rows.select("id", F.when(F.col("id") % 5 != 0, F.col("type")).alias("type")).join(
        spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x[:90])], "id bigint, a double, b double, c double"), "id")
    params = model.TreeParams(rounds=3, step=0.2, depth=2, features=1.0, sample=1.0, min_rows=1, patience=1, objective="softmax")
    runs = [model.cross_validate(wide, params, k=3, side_by_side=n) for n in (1, 3)]
    frames = [(r.oof.orderBy("id").toPandas(), r.scores.orderBy("id").toPandas(), r.importance.orderBy("fold", "feature").toPandas()) for r in runs]
    for a, b in zip(*frames):
        assert a.drop(columns=["type"], errors="ignore").round(9).equals(b.drop(columns=["type"], errors="ignore").round(9))
    oof = frames[0][0]
    assert oof["id"].is_unique and len(oof) == 72 and len(frames[0][1]) == 18
    np.testing.assert_allclose(oof[list(metrics.PROBABILITIES)].sum(axis=1), 1)


def test_unknown_objective(spark):
    rows, _, _ = table(spark, 30)
    with pytest.raises(ValueError):
        boosting.boost(rows.withColumn("held", F.lit(False)), model.TreeParams(1, 0.1, 1, 1.0, 1.0, objective="other"), 32)
