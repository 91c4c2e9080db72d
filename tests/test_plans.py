"""Marts, features and reports against plain SQL on small tables."""

from __future__ import annotations

from datetime import date

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import oracle_queries as oracle
from adlake.plans import ctr_model, reports
from adlake.plans import features as feat
from adlake.plans.marts import campaign_performance, campaign_summary
from check_oracle import actual, expected
from adlake.plans.staging import stage_all
from adlake.sources import testdata
from helpers import by_key, rows, silver_frames, staged_frames


@pytest.fixture(scope="module")
def raw(spark):
    return silver_frames(spark)


@pytest.fixture(scope="module")
def staged(spark):
    return staged_frames(spark)


@pytest.fixture(scope="module")
def con(raw):
    """The small tables under the names the SQL uses."""
    con = duckdb.connect()
    for name, df in raw.items():
        table = df.toArrow()
        con.register(f"arrow_{name}", table)
        con.execute(f"create table raw_{name} as select * from arrow_{name}")
        stamp = "timestamp" in table.column_names
        if stamp:
            con.execute(f'alter table raw_{name} alter "timestamp" type timestamp')
    return con


def with_parts(select, *parts):
    return "with" + ",".join(parts) + "\n" + select


def rounded(df):
    from __spark_entry__ import _plain

    return _plain(df)


TRAINING = (oracle.STAGED, oracle.TRAINING)
FEATURES = (*TRAINING, oracle.ENGAGEMENT, oracle.USER_FEATURES)


def test_campaign_summary(staged, con):
    sql = with_parts(f"select {oracle._MART_OUT} from mart", oracle.STAGED, oracle.MART)
    assert actual(rounded(campaign_summary(staged))) == expected(con, sql)


def test_campaign_without_events_has_null_counts(staged):
    perf = by_key(campaign_performance(staged), "campaign_id")
    assert perf[14]["conversions_count"] is None and perf[14]["total_revenue"] is None
    # conversions without any revenue sum to zero
    assert perf[13]["conversions_count"] == 1 and perf[13]["total_revenue"] == 0
    summary = by_key(campaign_summary(staged), "campaign_id")
    assert summary[11]["roi_percentage"] is None  # budget zero
    assert summary[12]["active_days"] == -1
    assert summary[11]["revenue_per_day"] is None  # zero days


def test_training_set(staged, con):
    sql = with_parts(
        "select * exclude (budget, user_click_rate, campaign_ctr_history), "
        + oracle.r6("budget", "user_click_rate", "campaign_ctr_history")
        + " from training",
        *TRAINING,
    )
    want = expected(con, sql)
    assert len(want[1]) > 30
    assert actual(rounded(feat.training_set(staged))) == want


def test_training_set_without_broadcasts(staged, con, no_broadcast):
    test_training_set(staged, con)


def test_training_set_reads_the_impressions_once(spark):
    """One write before the action (a job for each of its shuffles), and the stored log after."""
    staged = stage_all(testdata.silver_tables(spark, "/root/testdata/sf0.001"))
    tracker, group = spark.sparkContext.statusTracker(), "training-set"
    spark.sparkContext.setJobGroup(group, "building")
    rows = feat.training_set(staged)
    assert len(tracker.getJobIdsForGroup(group)) <= 3
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "ad_slot" not in plan and rows.count() > 100
    files = [f for f in rows.inputFiles() if "events" in f]
    assert len(files) <= 1  # the clicks


def test_rates(staged, con, no_broadcast):
    rate = feat.user_click_rate(staged["impressions"], staged["clicks"])
    sql = with_parts("select user_id, " + oracle.r6("user_click_rate") + " from rate", *TRAINING)
    assert actual(rounded(rate)) == expected(con, sql)
    history = feat.campaign_ctr_history(staged["impressions"], staged["clicks"])
    sql = with_parts(
        "select campaign_id, " + oracle.r6("campaign_ctr_history") + " from history", *TRAINING
    )
    assert actual(rounded(history)) == expected(con, sql)


def test_label_compares_with_the_first_click_only(spark):
    df = spark.sql(
        "select * from values (timestamp'2024-01-01 10:00', timestamp'2024-01-01 10:00', 1),"
        " (timestamp'2024-01-01 10:00', timestamp'2024-01-01 10:01', 0),"
        " (null, timestamp'2024-01-01 10:01', 0), (timestamp'2024-01-01 10:00', null, 0)"
        " as t(first, seen, label)"
    )
    got = df.select(feat.click_label(F.col("first"), F.col("seen")), "label").collect()
    assert all(a == b for a, b in got)


def scores(staged):
    training = feat.training_set(staged)
    score = F.least(F.lit(1.0), F.col("campaign_ctr_history"))
    return ctr_model.as_predictions(training.withColumn("predicted_prob", score))


@pytest.mark.parametrize("compat", [False, True])
def test_user_features(staged, con, compat, no_broadcast):
    source = "features_compat" if compat else "features"
    sql = with_parts(f"select {oracle._FEATURES_OUT} from {source}", *FEATURES)
    got = feat.user_features(staged, scores(staged), oracle.AS_OF, compat)
    want = expected(con, sql)
    assert actual(rounded(got)) == want
    assert len(want[1]) == 5


def test_compat_revenue_repeats_per_impression_and_click(staged):
    plain = by_key(feat.user_engagement(staged), "user_id")
    literal = by_key(feat.user_engagement(staged, compat=True), "user_id")
    rows_1 = staged["impressions"].filter("user_id = 1").count() * staged["clicks"].filter("user_id = 1").count()
    assert literal[1]["total_revenue"] == plain[1]["total_revenue"] * rows_1
    assert literal[5]["total_revenue"] == plain[5]["total_revenue"] == 0
    assert literal[1]["impressions"] == plain[1]["impressions"] == 40


def test_scores_match_literally_equal_keys(spark, staged):
    predictions = spark.createDataFrame(
        [("banner", "desktop", "feed", 0.4), ("banner", "desktop", "feed", 0.8), ("banner", "x", "y", 1.0)],
        "ad_format string, device string, target_region string, predicted_prob double",
    )
    got = rows(feat.user_scores(staged, predictions, compat=True))
    assert got == [(2, pytest.approx(0.6))]


# --- reports -----------------------------------------------------------------


@pytest.fixture(scope="module")
def summary(staged):
    return campaign_summary(staged).cache()


@pytest.fixture(scope="module")
def summary_pd(summary):
    pdf = summary.toPandas()
    for c in ("total_revenue", "budget"):
        pdf[c] = pdf[c].astype(float)
    return pdf


def test_filters(summary):
    assert reports.filter_campaigns(summary).count() == 5
    ids = lambda **f: {r["campaign_id"] for r in reports.filter_campaigns(summary, **f).collect()}
    assert ids(regions=["Us"]) == {10, 13}
    assert ids(regions=["Us", "Eu"], formats=["video"]) == {11}
    assert ids(advertisers=["zeta"], formats=["banner"]) == {14}
    assert ids(regions=["nowhere"]) == set()


def test_filter_values_skip_nulls(summary):
    got = [tuple(r) for r in reports.filter_values(summary).collect()]
    assert got == [
        ("ad_format", "banner"), ("ad_format", "video"),
        ("advertiser", "acme"), ("advertiser", "zeta"),
        ("target_region", "Apac"), ("target_region", "Eu"), ("target_region", "Us"),
    ]


def test_overview(summary, summary_pd):
    got = reports.kpi_overview(summary).first()
    assert got["total_impressions"] == summary_pd["impressions_count"].sum()
    assert got["total_spend"] == pytest.approx(summary_pd["budget"].sum())
    for out, c in (("avg_ctr", "ctr"), ("avg_cpc", "cpc"), ("avg_roi", "roi_percentage")):
        assert got[out] == pytest.approx(summary_pd[c].astype(float).mean())
    nothing = reports.kpi_overview(summary.limit(0)).first()
    assert all(v == 0.0 for v in nothing)


def test_rollups(summary, summary_pd):
    got = by_key(reports.advertiser_rollup(summary), "advertiser")
    want = summary_pd.groupby("advertiser")["total_revenue"].sum()
    assert {k: r["revenue"] for k, r in got.items()} == pytest.approx(want.to_dict())
    roi = by_key(reports.roi_by_region_format(summary), "target_region", "ad_format")
    assert ("Us", "banner") in roi and all(None not in k for k in roi)
    grid = by_key(reports.roi_grid(summary, ["banner", "video"]), "target_region")
    assert grid["Us"]["banner"] == roi["Us", "banner"]["roi_percentage"]
    assert grid["Us"]["video"] is None
    assert set(reports.roi_grid(summary).columns) == {"target_region", "banner", "video"}


def test_rankings(summary):
    ids = lambda df: [r["campaign_id"] for r in df.collect()]
    assert ids(reports.top_by_revenue(summary, 2)) == [10, 11]
    assert ids(reports.by_revenue(summary))[-1] == 14  # no revenue at all
    assert ids(reports.top_by_roi(summary, 1)) == [10] or ids(reports.top_by_roi(summary, 1)) == [12]
    assert reports.top_by_roi(summary).count() == 5


def test_bars(spark, summary, summary_pd):
    got = by_key(reports.campaign_bars(summary), "campaign_id")
    top = summary_pd["total_revenue"].max()
    for r in summary_pd.itertuples():
        if pd.notna(r.total_revenue):
            assert got[r.campaign_id]["total_revenue_bar"] == pytest.approx(r.total_revenue / top * 100)
    zero = summary.withColumn("budget", F.lit(0.0))
    assert {r["budget_bar"] for r in reports.campaign_bars(zero).collect()} == {0.0}


def test_pareto(spark):
    df = spark.createDataFrame(
        [("a", 5.0), ("b", 20.0), ("c", 5.0), ("b", 10.0), (None, 99.0), ("d", None)],
        "advertiser string, total_revenue double",
    )
    got = [(r["advertiser"], r["cum_pct"]) for r in reports.pareto(df).collect()]
    assert got == [("b", 75.0), ("a", 87.5), ("c", 100.0), ("d", 100.0)]
    zero = reports.pareto(df.withColumn("total_revenue", F.lit(0.0))).collect()
    assert {r["cum_pct"] for r in zero} == {None}


def test_funnel(summary, summary_pd):
    stages = [(r["stage"], r["total"]) for r in reports.funnel(summary).collect()]
    assert stages == [
        (s, float(summary_pd[f"{s}_count"].sum())) for s in ("impressions", "clicks", "conversions")
    ]
    first = reports.funnel(summary).first()
    assert first["step_rate"] is None and first["overall_rate"] == 1.0


def test_chart_columns(summary):
    assert reports.roi_vs_ctr(summary).count() == reports.spend_vs_revenue(summary).count() == 5
    assert reports.roi_vs_ctr(summary).columns == [
        "advertiser", "ad_format", "roi_percentage", "ctr", "budget"
    ]


def test_daily_spend_keeps_the_budgets(raw):
    spend = by_key(reports.daily_spend(raw["campaigns"]), "day")
    # campaign 12 ends before it starts, 13 has no start
    assert sum(r["spend"] for r in spend.values()) == pytest.approx(100.0 + 0.0 + 70.0 + 1.0)
    assert spend[date(2024, 1, 3)]["spend"] == pytest.approx(100 / 3)
    assert spend[date(2024, 1, 2)]["spend"] == pytest.approx(100 / 3)
    assert date(2024, 1, 5) not in spend


def test_daily_report(raw, con):
    sql = with_parts(
        f"select day, {oracle.r6('spend', 'revenue')}, impressions, clicks, "
        f"{oracle.r(oracle.div('spend', 'clicks'))} as cpc, "
        f"{oracle.r(oracle.div('clicks', 'impressions'))} as ctr from daily where day is not null",
        oracle.DAILY,
    )
    got = reports.daily_report(raw["campaigns"], raw["impressions"], raw["clicks"], raw["conversions"])
    assert actual(rounded(got)) == expected(con, sql)
    pct = by_key(reports.ctr_percent(got), "day")
    assert pct[date(2024, 1, 1)]["ctr_pct"] == pytest.approx(by_key(got, "day")[date(2024, 1, 1)]["ctr"] * 100)
    assert reports.revenue_spend_trend(got).columns == ["day", "revenue", "spend"]


def test_quartiles(spark):
    values = {"banner": [1.0, 2.0, 10.0], "video": [5.0]}
    df = spark.createDataFrame(
        [(f, v) for f, vs in values.items() for v in vs] + [("banner", None)],
        "ad_format string, roi_percentage double",
    )
    got = by_key(reports.roi_quartiles(df), "ad_format")
    assert tuple(got["banner"])[1:] == (1.0, 1.5, 2.0, 6.0, 10.0)
    assert tuple(got["video"])[1:] == (5.0,) * 5
