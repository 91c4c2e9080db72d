"""Click model, score reports and segments."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from adlake.plans import ctr_model, reports, segments
from helpers import by_key, rows


def predictions_frame(spark, scores, labels):
    data = [
        (int(i), ("banner", "video")[i % 2], ("Us", "Eu", "Apac")[i % 3], float(p), int(y))
        for i, (p, y) in enumerate(zip(scores, labels))
    ]
    df = spark.createDataFrame(
        data,
        "impression_id long, ad_format string, target_region string, predicted_prob double, "
        "actual_clicked int",
    )
    return df.withColumn("predicted_clicked", (F.col("predicted_prob") >= 0.5).cast("int"))


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(5)
    scores = np.round(rng.random(400), 2)  # many ties
    labels = (rng.random(400) < scores).astype(int)
    return scores, labels


@pytest.fixture(scope="module")
def predictions(spark, sample):
    return predictions_frame(spark, *sample).repartition(3).cache()


def test_auc(spark, predictions, sample):
    scores, labels = sample
    pos, neg = scores[labels == 1], scores[labels == 0]
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    got = ctr_model.roc_auc(predictions).first()
    assert got["auc"] == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)
    assert (got["positives"], got["negatives"]) == (len(pos), len(neg))
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    spark_auc = BinaryClassificationEvaluator(
        rawPredictionCol="predicted_prob", labelCol="actual_clicked"
    ).evaluate(predictions)
    assert got["auc"] == pytest.approx(spark_auc, abs=1e-9)


def test_auc_of_one_class_is_null(spark):
    assert ctr_model.roc_auc(predictions_frame(spark, [0.1, 0.2], [1, 1])).first()["auc"] is None


def test_classification_report(predictions, sample):
    scores, labels = sample
    guess = (scores >= 0.5).astype(int)
    got = by_key(ctr_model.classification_report(predictions), "label")
    f1s = {}
    for c in (0, 1):
        hit = ((guess == c) & (labels == c)).sum()
        precision, recall = hit / (guess == c).sum(), hit / (labels == c).sum()
        f1s[c] = 2 * precision * recall / (precision + recall)
        row = got[str(c)]
        assert row["precision"] == pytest.approx(precision)
        assert row["recall"] == pytest.approx(recall)
        assert row["f1"] == pytest.approx(f1s[c])
        assert row["support"] == (labels == c).sum()
    assert got["accuracy"]["f1"] == pytest.approx((guess == labels).mean())
    assert got["macro avg"]["f1"] == pytest.approx((f1s[0] + f1s[1]) / 2)
    share = labels.mean()
    assert got["weighted avg"]["f1"] == pytest.approx(f1s[0] * (1 - share) + f1s[1] * share)


def test_report_without_predicted_clicks(spark):
    got = by_key(ctr_model.classification_report(predictions_frame(spark, [0.1, 0.2], [1, 0])), "label")
    assert tuple(got["1"])[1:] == (0.0, 0.0, 0.0, 1)


@pytest.mark.parametrize("kind", ["ties", "continuous", "few", "one value", "empty"])
def test_calibration_equals_qcut(spark, kind):
    rng = np.random.default_rng(8)
    scores = {
        "ties": np.round(rng.random(211), 1),
        "continuous": rng.random(187),
        "few": np.array([0.1] * 90 + [0.5] * 7 + [0.9] * 3),
        "one value": np.array([0.3] * 12),
        "empty": np.array([]),
    }[kind]
    labels = (rng.random(len(scores)) < 0.4).astype(int)
    got = {
        r["decile"]: (r["predicted"], r["actual"], r["volume"])
        for r in reports.calibration(predictions_frame(spark, scores, labels)).collect()
    }
    pdf = pd.DataFrame({"p": scores, "y": labels})
    want = {}
    if len(pdf):
        try:
            bins = pd.qcut(pdf["p"], 10, labels=False, duplicates="drop")
        except ValueError:
            bins = pd.Series(np.nan, index=pdf.index)
        for d, part in pdf.assign(d=bins).dropna().groupby("d"):
            want[int(d) + 1] = (part["p"].mean(), part["y"].mean(), len(part))
    assert got.keys() == want.keys()
    for d in want:
        assert got[d] == pytest.approx(want[d])


def test_histograms(predictions, sample):
    scores, _ = sample
    got = {r["bin"]: r["volume"] for r in reports.score_histogram(predictions).collect()}
    want = pd.Series(np.minimum(np.floor(scores * 40), 39).astype(int)).value_counts().to_dict()
    assert got == want and sum(got.values()) == 400
    by_format = reports.score_histogram(predictions, 30, "ad_format")
    assert by_format.agg(F.sum("volume")).first()[0] == 400
    assert by_format.columns == ["ad_format", "bin", "volume", "lower_edge"]


def test_score_hierarchy_adds_up(predictions):
    leaves = by_key(reports.score_by_format_region(predictions), "ad_format", "target_region")
    tree = reports.score_hierarchy(predictions).collect()
    total = next(r for r in tree if r["node"] == "total")
    assert total["size"] == pytest.approx(sum(r["predicted_prob"] for r in leaves.values()))
    banner = next(r for r in tree if r["node"] == "format" and r["ad_format"] == "banner")
    ps = [r["predicted_prob"] for k, r in leaves.items() if k[0] == "banner"]
    assert banner["size"] == pytest.approx(sum(ps))
    assert banner["shade"] == pytest.approx(sum(p * p for p in ps) / sum(ps))
    assert sum(r["node"] == "leaf" for r in tree) == len(leaves) == 6


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(3)
    data = []
    for i in range(400):
        hour = rng.randrange(24)
        fmt = rng.choice(["banner", "video", "carousel"])
        clicked = int(rng.random() < (0.85 if fmt == "video" and hour >= 12 else 0.1))
        data.append(
            (i, i % 50, 1, "Us", "Mobile", "Basic", fmt, rng.choice(["Us", "Eu"]),
             float(100 + i % 7), hour, i % 7, int(18 <= hour <= 22), 0.1, 0.2, clicked)
        )
    return spark.createDataFrame(
        data,
        "impression_id long, user_id int, campaign_id int, region string, device string, "
        "subscription_tier string, ad_format string, target_region string, budget double, "
        "hour_of_day int, day_of_week int, is_peak_hour int, user_click_rate double, "
        "campaign_ctr_history double, clicked int",
    ).cache()


def test_scaler_uses_population_deviation(training):
    stats = by_key(ctr_model.scaler_statistics(training), "feature")
    pdf = training.toPandas()
    for c in ("budget", "hour_of_day"):
        assert stats[c]["mean"] == pytest.approx(pdf[c].mean())
        assert stats[c]["std"] == pytest.approx(pdf[c].std(ddof=0))
    constant = ctr_model.scaler_statistics(training.withColumn("budget", F.lit(5.0)))
    assert by_key(constant, "feature")["budget"]["std"] == 1.0
    scaled = ctr_model.scale(training, ctr_model.scaler_statistics(training)).toPandas()
    assert scaled["budget"].mean() == pytest.approx(0, abs=1e-9)


def test_class_weight(training):
    got = ctr_model.class_weight(training).first()
    assert got["negatives"] + got["positives"] == 400
    assert got["positive_weight"] == pytest.approx(got["negatives"] / got["positives"])


def test_model_learns_and_scores_the_test_part(spark, training):
    model, predictions = ctr_model.train_and_score(training, rounds=6, depth=3)
    assert predictions.count() == 80
    assert predictions.columns[:2] == ["impression_id", "user_id"]
    assert set(predictions.columns[2:]) == {
        *ctr_model.FEATURES, "actual_clicked", "predicted_prob", "predicted_clicked"
    }
    assert ctr_model.roc_auc(predictions).first()["auc"] > 0.7
    importance = ctr_model.feature_importance(spark, model).collect()
    assert sum(r["importance"] for r in importance) == pytest.approx(1.0)
    assert [r["importance"] for r in importance] == sorted((r["importance"] for r in importance), reverse=True)
    assert {importance[0]["feature"], importance[1]["feature"]} == {"ad_format", "hour_of_day"}
    assert reports.top_features(spark.createDataFrame(importance), 3).count() == 3
    # a category that training did not see is scored all the same
    odd = training.limit(3).withColumn("ad_format", F.lit("hologram"))
    assert ctr_model.predict(model, odd).filter("predicted_prob is not null").count() == 3


def test_missing_values_are_trained_and_scored(training):
    holes = {c: F.when(F.col("impression_id") % 5 > 0, F.col(c)) for c in ("budget", "day_of_week", "subscription_tier")}
    _, predictions = ctr_model.train_and_score(training.withColumns(holes), rounds=1, depth=2)
    assert predictions.count() == 80
    assert predictions.filter("budget is null and predicted_prob is not null").count() > 0


# --- segments ----------------------------------------------------------------

D = len(segments.FEATURES)


@pytest.fixture(scope="module")
def users(spark):
    rng = np.random.default_rng(4)
    centers = np.array([[0] * D, [50] * D, [200] * D, [800] * D], dtype=float)
    data = []
    for i in range(240):
        x = centers[i % 4] + rng.normal(0, 2, D)
        data.append((i, ("Us", "Eu", None)[i % 3], ("Mobile", "Tablet")[i % 2], "Basic", *map(float, x)))
    columns = ", ".join(f"{c} double" for c in segments.FEATURES)
    return spark.createDataFrame(
        data, f"user_id int, region string, device string, subscription_tier string, {columns}"
    ).cache()


@pytest.fixture(scope="module")
def assigned(users):
    return segments.assign_segments(users).cache()


def test_segments_recover_the_groups(users, assigned):
    got = assigned.toPandas()
    assert len(got) == 240
    groups = got.groupby(got["user_id"] % 4)["user_cluster"].nunique()
    assert (groups == 1).all() and got["user_cluster"].nunique() == 4
    assert got.set_index("user_id")["clicks"].to_dict() == users.toPandas().set_index("user_id")["clicks"].to_dict()


def test_missing_features_count_as_zero(spark, users):
    holed = users.withColumn("clicks", F.when(F.col("user_id") > 0, F.col("clicks")))
    assert segments.model_input(holed).filter("user_id = 0").first()["clicks"] == 0.0


def test_standardize(users):
    got = segments.standardize(segments.model_input(users)).toPandas()
    x = users.toPandas()[list(segments.FEATURES)].to_numpy()
    want = (x - x.mean(axis=0)) / x.std(axis=0)
    assert np.allclose(got[list(segments.FEATURES)].to_numpy(), want)


def test_nearest_center_takes_the_first_on_ties(spark):
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 0.0)], "a double, b double")
    got = segments.nearest_center(df, [(1.0, 0.0), (-1.0, 0.0), (4.0, 0.0)], ("a", "b"))
    assert rows(got) == [(0.0, 0.0, 1.0, 0), (3.0, 0.0, 1.0, 2)]
    assert segments.inertia(got).first()[:] == (2.0, 2)


def test_minibatch_step_equals_the_point_loop(spark):
    rng = np.random.default_rng(6)
    points = rng.normal(0, 3, (20, 2))
    centers = np.array([[-2.0, 0.0], [2.0, 1.0], [90.0, 90.0]])
    counts = [3, 0, 5]
    df = spark.createDataFrame([tuple(map(float, p)) for p in points], "a double, b double")
    got = by_key(segments.minibatch_step(df, centers.tolist(), counts, ("a", "b")), "user_cluster")
    label = ((points[:, None, :] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
    moved, seen = centers.copy(), list(counts)
    for p, j in zip(points, label):
        seen[j] += 1
        moved[j] += (p - moved[j]) / seen[j]
    assert set(got) == set(label)
    for j in set(label):
        assert got[j]["seen"] == seen[j]
        assert (got[j]["a"], got[j]["b"]) == pytest.approx(tuple(moved[j]))


def test_seeds_are_distinct_points(users):
    scaled = segments.standardize(segments.model_input(users))
    seeds = segments.seed_centers(scaled, 4, 42)
    points = {tuple(r) for r in scaled.select(*segments.FEATURES).collect()}
    assert len({tuple(s) for s in seeds}) == 4 and {tuple(s) for s in seeds} <= points
    assert seeds == segments.seed_centers(scaled, 4, 42)
    same = scaled.withColumns({c: F.lit(1.0) for c in segments.FEATURES})
    assert len(segments.seed_centers(same, 4, 42)) == 1


def test_minibatch_centers_lower_the_inertia(users):
    scaled = segments.standardize(segments.model_input(users))
    def spread(centers):
        return segments.inertia(segments.nearest_center(scaled, centers)).first()["inertia"]
    centers = segments.fit_centers_minibatch(scaled, 4, batch_size=40, batches=4)
    assert len(centers) == 4
    assert spread(centers) < spread([[0.0] * D])
    assert spread(segments.fit_centers(scaled, 4)) < spread([[0.0] * D]) / 10


def test_batches_have_about_the_asked_size(users):
    drawn = segments.draw_batches(users, 60, 10)
    sizes = {r["batch"]: r["count"] for r in drawn.groupBy("batch").count().collect()}
    assert set(sizes) == set(range(10)) and 400 < sum(sizes.values()) < 800
    assert segments.draw_batches(users, 1000, 2).count() == 480  # all rows in each


def test_cluster_reports(assigned, spark):
    pdf = assigned.toPandas()
    summary = segments.cluster_summary(assigned)
    got = by_key(summary, "user_cluster")
    for c, part in pdf.groupby("user_cluster"):
        for f in segments.FEATURES:
            assert got[c][f] == pytest.approx(part[f].mean(), abs=0.0051)
    rollup = by_key(segments.segment_rollup(assigned), "user_cluster")
    for c, part in pdf.groupby("user_cluster"):
        assert rollup[c]["users"] == len(part)
        assert rollup[c]["revenue"] == pytest.approx(part["total_revenue"].sum())
    best = [r["user_cluster"] for r in segments.top_clusters(assigned).collect()]
    want = pdf.groupby("user_cluster")["total_revenue"].sum().sort_values(ascending=False)
    assert best == want.index[:3].tolist()
    cells = segments.segment_region_device(assigned).collect()
    kept = pdf[pdf["user_cluster"].isin(best)].dropna(subset=["region", "device"])
    assert sum(r["users"] for r in cells) == len(kept)
    assert {r["user_cluster"] for r in cells} == set(best)
    ranks = by_key(segments.rank_clusters(summary), "user_cluster")
    assert ranks[best[0]]["value_rank"] == 3
    assert [r["user_cluster"] for r in segments.clusters_by_value(assigned).collect()][0] == best[0]
    kpis = segments.segment_kpis(assigned, summary).first()
    assert (kpis["total_users"], kpis["clusters"]) == (240, 4)
    assert kpis["user_revenue"] == pytest.approx(pdf["total_revenue"].sum())
    assert kpis["segment_revenue"] == pytest.approx(sum(r["total_revenue"] for r in got.values()))


def test_share_names_and_empty_clusters(spark, assigned):
    summary = segments.cluster_summary(assigned).unionByName(
        segments.cluster_summary(assigned).limit(1).withColumn("user_cluster", F.lit(9))
    )
    share = by_key(segments.segment_share(assigned, summary), "user_cluster")
    assert share[9]["users"] == 0 and share[9]["cluster_name"] == "9"
    assert sum(r["share_pct"] for r in share.values()) == pytest.approx(100.0)
    assert share[2]["cluster_name"] == "High Value"
    value = segments.segment_value(summary)
    assert value.columns == ["cluster_name", "total_revenue", "conversions", "days_since_signup"]
    long = segments.segment_engagement(summary)
    assert long.count() == 10 and long.columns == ["cluster_name", "metric", "value"]


def test_equal_rows_are_fitted_as_one(spark, monkeypatch):
    """Equal rows weigh as many as they are, in pieces of bounded weight, and fit the same trees."""
    rng = random.Random(4)
    kinds = [
        (rng.choice("ab"), "m", None, rng.choice("xyz"), "eu", float(rng.randrange(5)), rng.randrange(4), 1, 0, 0.5, rng.random(), rng.random() < 0.4)
        for _ in range(60)
    ]
    rows_ = [(i, i, *k[:-1], int(k[-1])) for i, k in enumerate(kinds * 40)]
    schema = (
        "impression_id long, user_id long, region string, device string, subscription_tier string, ad_format string,"
        " target_region string, budget double, hour_of_day int, day_of_week int, is_peak_hour int,"
        " user_click_rate double, campaign_ctr_history double, clicked int"
    )
    train = spark.createDataFrame(rows_, schema)
    found = ctr_model.condensed(train.select("clicked", *ctr_model.FEATURES)).collect()
    assert len(found) == 60 * 3  # 40 copies in pieces of 16 at most
    assert all(r["copies"] == pytest.approx(40 / 3) for r in found)

    # The trees get these rows only.
    seen, fit = [], ctr_model.GBTClassifier.fit
    monkeypatch.setattr(ctr_model.GBTClassifier, "fit", lambda self, df: (seen.append(df.count()), fit(self, df))[1])
    options = {"rounds": 3, "depth": 3, "row_share": 1.0, "feature_share": 1.0}
    joined = ctr_model.fit(train, **options)
    monkeypatch.setattr(ctr_model, "condensed", lambda rows: rows.withColumn("copies", F.lit(1.0)))
    apart = ctr_model.fit(train, **options)
    assert seen == [180, 2400]
    score = lambda m: {r[0]: r[1] for r in ctr_model.predict(m, train).select("impression_id", "predicted_prob").collect()}
    one, other = score(joined), score(apart)
    assert len(set(other.values())) > 3
    assert all(one[i] == pytest.approx(other[i], abs=1e-9) for i in other)


def test_trees_are_fitted_to_all_rows(spark, monkeypatch):
    """No number of rows from which on the fit takes a part of them: none is left in its defaults."""
    rng = random.Random(8)
    rows_ = [
        (i, i, rng.choice("ab"), "m", None, rng.choice("xyz"), "eu", rng.random(), i % 24, 1, 0, 0.5, rng.random(), int(i % 3 == 0))
        for i in range(900)
    ]
    schema = (
        "impression_id long, user_id long, region string, device string, subscription_tier string, ad_format string,"
        " target_region string, budget double, hour_of_day int, day_of_week int, is_peak_hour int,"
        " user_click_rate double, campaign_ctr_history double, clicked int"
    )
    # What bounds rows at a million or more bounds them at a hundred here.
    small = tuple(100 if isinstance(d, int) and d >= 1_000_000 else d for d in ctr_model.fit.__defaults__)
    monkeypatch.setattr(ctr_model.fit, "__defaults__", small)
    seen, fit = [], ctr_model.GBTClassifier.fit
    counts = F.sum("copies"), F.sum(F.when(F.col("clicked") == 1, F.col("copies")))
    monkeypatch.setattr(ctr_model.GBTClassifier, "fit", lambda self, df: (seen.append(df.agg(*counts).first()), fit(self, df))[1])
    ctr_model.fit(spark.createDataFrame(rows_, schema), rounds=1, depth=2)
    assert [tuple(s) for s in seen] == [(900, 300)]
