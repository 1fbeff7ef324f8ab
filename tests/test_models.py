"""SVD, Word2Vec, boosted trees, files, and the whole ensemble on small tracks."""

import csv
import glob

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.functions import scalars as S
from wakeline.operators import factor, metrics, model, text
from wakeline.plans import ensemble, members
from wakeline.sources import sinks, tracks

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pings(spark):
    return tracks.from_events(spark, SF_DIR)


@pytest.fixture(scope="module")
def matrix(pings):
    words = text.CORPORA["geohash"].words(pings)
    documents = text.document_ids(words)
    cells = text.tfidf(text.token_counts(words), documents)
    return cells, documents


def test_svd_matches_numpy(matrix):
    cells, documents = matrix
    got = factor.truncated_svd(cells, documents, 5, "v").toPandas().set_index("id").sort_index()
    x = cells.toPandas().pivot(index="id", columns="token", values="weight").fillna(0).sort_index()
    u, s, _ = np.linalg.svd(x.to_numpy(), full_matrices=False)
    want = u[:, :5] * s[:5]
    want = want * np.sign(want[np.abs(want).argmax(0), range(5)])
    np.testing.assert_allclose(got.to_numpy(), want, atol=1e-4)  # at most 20 rounds on close singular values


def test_svd_keeps_small_directions(spark):
    cells = spark.createDataFrame([(i, f"t{i}", 10.0 ** -i) for i in range(5)], "id bigint, token string, weight double")
    rows = factor.truncated_svd(cells, spark.range(5), 5, "v").orderBy("id").collect()
    np.testing.assert_allclose(np.array([list(r)[1:] for r in rows]), np.diag([10.0 ** -i for i in range(5)]), atol=1e-9)


def test_svd_of_nothing(spark):
    cells = spark.createDataFrame([], "id bigint, token string, weight double")
    assert [tuple(r) for r in factor.truncated_svd(cells, spark.range(1, 2), 2, "v").collect()] == [(1, 0.0, 0.0)]


def test_svd_beyond_the_rank_scores_zero(spark):
    cells = spark.createDataFrame([(1, "aa", 3.0), (2, "bb", 4.0)], "id bigint, token string, weight double")
    rows = factor.truncated_svd(cells, spark.range(1, 4), 4, "v").orderBy("id").collect()
    got = np.array([list(r)[1:] for r in rows])
    np.testing.assert_allclose(np.abs(got), [[0, 3, 0, 0], [4, 0, 0, 0], [0, 0, 0, 0]], atol=1e-9)


@pytest.mark.parametrize("limit", [10 ** 6, 60, 1])
def test_products_in_blocks_match_numpy(spark, limit):
    """Whatever ids are too long for a block; the blocks get each token once, not each cell."""
    rng = np.random.default_rng(1)
    x = rng.random((400, 90)) * (rng.random((400, 90)) < np.linspace(0.05, 1, 400)[:, None])
    v = rng.random((90, 2))
    cells = factor.settle(spark.createDataFrame([(int(i), f"t{j}", float(x[i, j])) for i, j in zip(*x.nonzero())],
                                                "id bigint, token string, weight double"))
    vectors = spark.createDataFrame([(f"t{j}", *map(float, v[j])) for j in range(89)], "token string, a double, b double")
    v[89] = 0  # t89 is unknown
    placed = factor.PlacedCells.of(cells, block_cells=5000, limit=limit)
    by_id = np.array([list(r) for r in placed.by_id(vectors, ["a", "b"]).groupBy("id").sum("a", "b").orderBy("id").collect()])
    np.testing.assert_allclose(by_id[:, 1:], (x @ v)[by_id[:, 0].astype(int)], atol=1e-9)
    assert (x @ v)[np.setdiff1d(range(400), by_id[:, 0])].sum() == 0
    by_token = {r["token"]: (r["a"], r["b"]) for r in placed.by_token(vectors, ["a", "b"]).collect()}
    np.testing.assert_allclose([by_token[f"t{j}"] for j in range(89)], (x.T @ (x @ v))[:89], atol=1e-9)
    assert placed.tokens.count() <= 90 * 4 < cells.count() / 20


def test_word_vectors_depend_on_neither_partitions_nor_cuts(pings):
    def vectors(p, **settings):
        return (factor.word2vec_means(p, size=4, iterations=20, **settings).toPandas().set_index("id").sort_index())
    one, eight, cut = vectors(pings.coalesce(1)), vectors(pings.repartition(8)), vectors(pings, chunk=7)
    assert len(one) == pings.select("id").distinct().count()
    np.testing.assert_allclose(one, eight, atol=1e-6)
    np.testing.assert_allclose(one, cut, atol=1e-6)


def test_skipgram_is_repeatable_and_refuses_large_vocabularies(pings):
    one = factor.skipgram_means(pings.coalesce(1), size=4, iterations=1).toPandas().set_index("id").sort_index()
    eight = factor.skipgram_means(pings.repartition(8), size=4, iterations=1).toPandas().set_index("id").sort_index()
    np.testing.assert_allclose(one, eight, atol=1e-6)
    with pytest.raises(ValueError):
        factor.skipgram_means(pings, size=4, iterations=1, max_floats=0)


def test_context_weights_by_hand(spark):
    """aa bb aa cc with window 1: pairs ab 2, ac 1, each counted both ways."""
    sentence = spark.createDataFrame([(1, 0, ["aa", "bb"], ["aa"]), (1, 1, ["aa", "cc"], [])],
                                     "id bigint, part bigint, tokens array<string>, ahead array<string>")
    got = {(r["token"], r["context"]): r["weight"] for r in factor.context_weights(sentence, 1, 1).collect()}
    assert set(got) == {("aa", "bb"), ("bb", "aa"), ("aa", "cc"), ("cc", "aa")}
    assert all(v == pytest.approx(np.log(2)) for v in got.values())


def test_mean_vectors(spark):
    counts = spark.createDataFrame([(1, "aa", 3), (1, "bb", 1), (2, "bb", 2)], "id bigint, token string, n bigint")
    vectors = spark.createDataFrame([("aa", [1.0, 0.0]), ("bb", [5.0, 8.0])], "token string, v array<double>")
    rows = factor.mean_vectors(counts, vectors, 2, "w").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 2.0, 2.0), (2, 5.0, 8.0)]


def test_feature_counts(pings):
    small = dict(k=2, iterations=1)
    assert len(members.features_a(pings, w2v_rounds=1, **small).columns) - 2 == 318 - 4 * 30 + 4 * 2
    b = members.features_b(pings, **small)
    assert len(b.columns) - 2 == 181 - 5 * 10 + 5 * 2
    kept = model.drop_by_substring(b, members.DROPPED_B)
    assert len(kept.columns) - 2 == 155 - 5 * 10 + 5 * 2
    c = members.features_c(pings, **small)
    assert len(c.columns) - 2 == 199 - 2 * 30 + 2 * 2
    ids = pings.select("id").distinct().count()
    assert b.count() == c.count() == ids


def test_cross_validation(pings):
    from wakeline.operators import stats
    table = stats.stat_block(pings, stats.decile_stats(["lat", "speed"])).join(tracks.track_labels(pings), "id")
    params = model.TreeParams(rounds=3, step=0.2, depth=2, features=0.8, sample=0.9, min_rows=1, patience=2)
    fitted = model.cross_validate(table, params, k=2)
    oof = fitted.oof.collect()
    known = tracks.labelled(tracks.distinct_tracks(pings)).count()
    assert len(oof) == known == len({r["id"] for r in oof})
    for r in oof + fitted.scores.collect():
        assert r["p_trawl"] + r["p_gill"] + r["p_seine"] == pytest.approx(1.0)
    assert metrics.top_features(fitted.importance, 5).count() == 5


def test_best_round():
    rising_late = [0.5, 0.6, 0.7, *[0.6] * 12, 0.9, 0.8]
    assert model.best_round(rising_late, 100) == (16, False)
    assert model.best_round(rising_late, 12) == (3, True)
    assert model.best_round([0.4, 0.4, 0.4], 9) == (1, False)


def test_prefixes_score_like_shorter_fits(pings):
    from wakeline.operators import stats
    table = stats.stat_block(pings, stats.decile_stats(["lat", "speed"])).join(tracks.track_labels(pings), "id")
    ready = tracks.labelled(model.assemble(table, model.feature_columns(table), ["id", "type"]))
    valid = ready.filter("id % 3 = 0")
    params = model.TreeParams(rounds=4, step=0.2, depth=3, features=1.0, sample=0.9, min_rows=1)
    long = model.fit_rest(ready, params)
    f1 = model.f1_by_round(long, valid)
    for n in (1, 3, 4):
        short = model.fit_rest(ready, model.replace(params, rounds=n))
        plain = metrics.with_prediction(model.score_rest(model.Ensemble(short, n), valid)).withColumn("label", F.col("type"))
        assert metrics.macro_f1(plain).first()["macro_f1"] == pytest.approx(f1[n - 1])
        ours = model.score_rest(model.Ensemble(long, n), valid).toPandas().set_index("id").sort_index()
        p = [short[i].transform(valid).toPandas().set_index("id").sort_index()["probability"].map(lambda v: v[1]) for i in range(3)]
        for i, name in enumerate(metrics.PROBABILITIES):
            np.testing.assert_allclose(ours[name], p[i] / sum(p), atol=1e-6)


def test_categorical_column_is_split_by_category(spark):
    rows = [(i, S.CLASSES[i % 3], float(i % 2), f"{'xyz'[i % 3]}{i % 100}" if i % 11 else None) for i in range(600)]
    table = spark.createDataFrame(rows, "id bigint, type string, noise double, kind string")
    ready = model.assemble(table, ["noise", "kind"], ["id", "type"], ["kind"])
    params = model.TreeParams(rounds=2, step=0.5, depth=2, features=1.0, sample=1.0, min_rows=1, bins=32)
    scored = metrics.with_prediction(model.score_rest(model.fit_best(ready, ready, params), ready))
    assert scored.filter("id % 11 <> 0 and predicted <> type").count() == 0
    assert "kind" in str(ready.schema["x"].metadata)


def write_vessels(pings, folder, labelled):
    """One source-format CSV per vessel, named after it, newest ping first."""
    folder.mkdir()
    native = {n: t for t, n in S.CLASS_TEXT.items()}
    names = list(tracks.FILE_COLUMNS)[: None if labelled else -1]
    rows = pings.orderBy(F.desc("ts")).collect()
    for vessel in sorted({r["id"] for r in rows}):
        with open(folder / f"{vessel}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(names)
            for r in rows:
                if r["id"] == vessel:
                    line = [vessel, r["lat"], r["lon"], r["speed"], r["direction"], r["ts"].strftime("%m%d %H:%M:%S")]
                    out.writerow(line + ([native[r["type"]]] if labelled else []))


def test_files_keep_their_row_order(spark, pings, tmp_path):
    write_vessels(pings.filter("type is not null and id < 6"), tmp_path / "train", True)
    back = tracks.read_tracks(spark, str(tmp_path / "train"), id_from_file=True)
    for vessel in {r["id"] for r in back.select("id").distinct().collect()}:
        times = [r["ts"] for r in back.filter(F.col("id") == vessel).orderBy("seq").collect()]
        assert times == sorted(times, reverse=True)


def test_split_files_keep_their_row_order(spark, tmp_path):
    folder = tmp_path / "one"
    folder.mkdir()
    with open(folder / "7.csv", "w", encoding="utf-8") as f:
        f.write(",".join(tracks.FILE_COLUMNS) + "\n")
        for i in range(4000):
            f.write(f"7,{30 + i / 1000},120.0,1.0,{i % 360},0101 {i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d},拖网\n")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = tracks.read_tracks(spark, str(folder))
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 3
        rows = df.orderBy("seq").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert [r["seq"] for r in rows] == list(range(4000))
    assert [r["lat"] for r in rows] == [30 + i / 1000 for i in range(4000)]


def test_large_files_keep_their_row_order(spark, tmp_path):
    for vessel, n in ((7, 3000), (8, 40)):
        with open(tmp_path / f"{vessel}.csv", "w", encoding="utf-8") as f:
            f.write(",".join(tracks.FILE_COLUMNS) + "\n")
            for i in range(n):
                f.write(f"{vessel},{30 + i / 1000},120.0,1.0,{i % 360},0101 {i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d},拖网\n")
    rows = tracks.read_tracks(spark, str(tmp_path), limit=500).orderBy("id", "seq").collect()
    assert [(r["id"], r["seq"]) for r in rows] == [(7, i) for i in range(3000)] + [(8, i) for i in range(40)]
    assert [r["lat"] for r in rows] == [30 + i / 1000 for n in (3000, 40) for i in range(n)]


def test_files_are_opened_once(spark, pings, tmp_path):
    """The rows are counted and numbered from what was parsed, not from the files again."""
    write_vessels(pings.filter("type is not null and id < 6"), tmp_path / "train", True)
    plan = tracks.read_tracks(spark, str(tmp_path / "train"))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan csv" not in plan


def test_row_numbers_do_not_depend_on_packing(spark, pings, tmp_path):
    write_vessels(pings.filter("type is not null and id < 9"), tmp_path / "train", True)
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    tables = []
    try:
        for cost in ("1", "100000000"):
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
            df = tracks.read_tracks(spark, str(tmp_path / "train"))
            tables.append((df.toPandas().sort_values(["id", "seq"]).reset_index(drop=True),
                           {tuple(r) for r in text.sample_rows(df).select("id", "seq").collect()}))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)
    assert tables[0][0].equals(tables[1][0]) and tables[0][1] == tables[1][1]
    assert dict(tracks.read_tracks(spark, str(tmp_path / "train")).dtypes)["seq"] == "bigint"
    assert set(tables[0][0].groupby("id")["seq"].min()) == {0}


def test_times_do_not_depend_on_the_zone(spark):
    rows = spark.createDataFrame([("0310 02:30:00",), ("0310 03:30:00",), ("0229 00:00:00",), ("310 2:3:4",), (None,)], "time string")
    old = spark.conf.get("spark.sql.session.timeZone")
    got = []
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got.append([str(r[0]) for r in rows.select(S.parse_time("time").cast("string")).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got[0] == got[1] == ["2019-03-10 02:30:00", "2019-03-10 03:30:00", "None", "None", "None"]


def test_bad_values_become_null(spark, tmp_path):
    folder = tmp_path / "bad"
    folder.mkdir()
    (folder / "1.csv").write_text(",".join(tracks.FILE_COLUMNS) + "\n1,NaN,120.0,1.0,3,0229 00:00:00,拖网\n", encoding="utf-8")
    row = tracks.read_tracks(spark, str(folder)).first()
    assert row["lat"] is None and row["ts"] is None and row["type"] == "trawl"


def test_labels_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "trawl"), (2, "seine")], "id bigint, label string")
    sinks.write_labels(df, str(tmp_path / "out"))
    lines = "".join(open(f, encoding="utf-8").read() for f in glob.glob(str(tmp_path / "out" / "part*"))).split()
    assert sorted(lines) == ["1,拖网", "2,围网"]


def test_whole_ensemble(spark, pings, tmp_path):
    write_vessels(pings.filter("type is not null"), tmp_path / "train", True)
    write_vessels(pings.filter("type is null"), tmp_path / "test", False)
    tiny = model.TreeParams(rounds=1, step=0.1, depth=1, features=0.2, sample=1.0, min_rows=1)
    options = {"a": dict(k=2, iterations=1, w2v_rounds=1), "b": dict(k=2, iterations=1), "c": dict(k=2, iterations=1)}
    base = ensemble.load(spark, str(tmp_path / "train"), str(tmp_path / "test"))
    fitted = ensemble.fit_members(base, {m: tiny for m in "abc"}, k=2, **options)
    labels = ensemble.blend_members(base, fitted).collect()
    assert {r["id"] for r in labels} == {r["id"] for r in pings.filter("type is null").select("id").distinct().collect()}
    assert all(r["label"] in S.CLASSES for r in labels)
    report = ensemble.report(fitted["a"])
    assert 0 <= report["macro_f1"].first()["macro_f1"] <= 1
    assert report["top"].count() == 5
