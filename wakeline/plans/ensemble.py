"""From labelled and unlabelled track files to the blended labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wakeline.operators import metrics
from wakeline.operators.model import MEMBER_PARAMS, CrossValidated, TreeParams, cross_validate
from wakeline.operators.skew import settle
from wakeline.plans import members
from wakeline.sources import sinks, tracks

# Fold seeds of the members and the weights of the blend.
FOLD_SEEDS = {"a": 1024, "b": 2019, "c": 1996}
BLEND_WEIGHTS = {"a": 0.5, "c": 0.3, "b": 0.2}


def load(spark: SparkSession, train_dir: str, test_dir: str) -> DataFrame:
    """Labelled and unlabelled files as one ping table, written once as Parquet."""
    both = tracks.union_tracks(tracks.read_tracks(spark, train_dir),
                               tracks.read_tracks(spark, test_dir, labelled=False))
    return settle(both)


def fit_members(pings: DataFrame, params: dict[str, TreeParams] | None = None, k: int = 5,
                **feature_options) -> dict[str, CrossValidated]:
    """Features, folds and models of the three members."""
    params = params or MEMBER_PARAMS
    build = {"a": members.features_a, "b": members.features_b, "c": members.features_c}
    out = {}
    for name, features in build.items():
        table = settle(features(pings, **feature_options.get(name, {})))
        out[name] = cross_validate(table, params[name], k, FOLD_SEEDS[name],
                                   drop=members.DROPPED_B if name == "b" else ())
    return out


def blend_members(pings: DataFrame, fitted: dict[str, CrossValidated]) -> DataFrame:
    """(id, p_<class>..., label) of the unlabelled tracks."""
    ids = tracks.unlabelled(tracks.distinct_tracks(pings)).select("id")
    order = list(BLEND_WEIGHTS)
    return metrics.blend(ids, [fitted[m].scores for m in order], [BLEND_WEIGHTS[m] for m in order])


def report(fitted: CrossValidated) -> dict[str, DataFrame]:
    """Out-of-fold scores of a member: overall, per class, over the folds, top features."""
    oof = metrics.with_prediction(fitted.oof).withColumn("label", F.col("type"))
    return {"macro_f1": metrics.macro_f1(oof), "classes": metrics.class_report(oof),
            "folds": metrics.fold_summary(oof), "top": metrics.top_features(fitted.importance)}


def run(spark: SparkSession, train_dir: str, test_dir: str, out_dir: str,
        params: dict[str, TreeParams] | None = None, **feature_options) -> DataFrame:
    """The whole job: writes each member's probabilities and the blended labels."""
    pings = load(spark, train_dir, test_dir)
    fitted = fit_members(pings, params, **feature_options)
    for name, member in fitted.items():
        sinks.write_probabilities(member.scores, f"{out_dir}/prob_{name}")
    labels = settle(blend_members(pings, fitted))
    sinks.write_labels(labels, f"{out_dir}/result")
    return labels
