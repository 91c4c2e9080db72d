"""Registered queries and their SQL counterparts."""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable
from datetime import timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracle_queries
from adlake.functions.scalars import ratio, rounded, safe_divide
from adlake.operators import daily_keys, quality, sketches
from adlake.plans import ctr_model, examples, incremental, model_store, reports, segments
from adlake.plans import features as feat
from adlake.plans.marts import campaign_performance, campaign_summary
from adlake.plans.pipeline import LOGS
from adlake.plans.silver import clean_and_rejected, repair_money, silver, unparsed_values
from adlake.plans.staging import stage_all
from adlake.session import materialize, work_dir, work_path
from adlake.sources import landing, results, tables, testdata, versions
from adlake.sources.schemas import ENTITIES, PREDICTIONS_SCHEMA
from adlake.streaming import daily, ingest

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = oracle_queries.AS_OF
CENTERS = oracle_queries.CENTERS
SEEN = oracle_queries.SEEN
FILTER = {"regions": ["Asia", "Europe"], "formats": ["video", "carousel"]}


def _plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Decimals and doubles as doubles of at most six decimals, for comparison."""
    numbers = {
        f.name: rounded(F.col(f"`{f.name}`"), digits)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType))
    }
    return df.withColumns(numbers) if numbers else df


def _raw(spark: SparkSession, sf: str) -> tables.LazyTables:
    return testdata.silver_tables(spark, sf)


def _staged(spark: SparkSession, sf: str) -> tables.LazyTables:
    return stage_all(_raw(spark, sf))


def _mart(spark: SparkSession, sf: str) -> DataFrame:
    return campaign_summary(_staged(spark, sf))


def _training(spark: SparkSession, sf: str) -> DataFrame:
    return feat.training_set(_staged(spark, sf))


def _score(staged: tables.LazyTables) -> DataFrame:
    """Predictions with a score that needs no trained model (see FIXTURES.md)."""
    score = F.least(F.lit(1.0), F.col("campaign_ctr_history"))
    rows = feat.training_set(staged).withColumn("predicted_prob", score)
    return ctr_model.as_predictions(rows)


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return _score(_staged(spark, sf))


def _features(spark: SparkSession, sf: str, compat: bool = False) -> DataFrame:
    staged = _staged(spark, sf)
    return feat.user_features(staged, _score(staged), AS_OF, compat)


def _scaled(spark: SparkSession, sf: str) -> DataFrame:
    return segments.standardize(materialize(segments.model_input(_features(spark, sf))))


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    return segments.assign_segments(_features(spark, sf), CENTERS)


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    raw = _raw(spark, sf)
    return reports.daily_report(
        raw["campaigns"], raw["impressions"], raw["clicks"], raw["conversions"]
    )


def _silver_query(entity: str) -> Query:
    return lambda spark, sf: silver(testdata.bronze_records(spark, sf, entity), entity)


def _staging_query(entity: str) -> Query:
    return lambda spark, sf: _staged(spark, sf)[entity]


def _on_mart(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: report(_mart(spark, sf))


def _on_scores(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: report(_scores(spark, sf))


def _on_segments(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: report(_segments(spark, sf))


def _on_clusters(report: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        users = _segments(spark, sf)
        return report(users, segments.cluster_summary(users))

    return run


def _user_click_rate(spark: SparkSession, sf: str) -> DataFrame:
    staged = _staged(spark, sf)
    return feat.user_click_rate(staged["impressions"], staged["clicks"])


def _campaign_ctr_history(spark: SparkSession, sf: str) -> DataFrame:
    staged = _staged(spark, sf)
    return feat.campaign_ctr_history(staged["impressions"], staged["clicks"])


def _labelled(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The stored training set, as its split reads it several times, in few columns."""
    return materialize(_training(spark, sf).select("impression_id", "clicked", *columns))


def _split(spark: SparkSession, sf: str) -> DataFrame:
    return ctr_model.split(_labelled(spark, sf)).select("impression_id", "clicked", "is_test")


def _train_part(spark: SparkSession, sf: str) -> DataFrame:
    return ctr_model.split(_labelled(spark, sf, *ctr_model.SCALED)).filter(~F.col("is_test"))


def _model_store(spark: SparkSession) -> str:
    return f"{work_dir(spark).rstrip('/')}/models/clicks"


def _marked(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(ctr_model.split(materialize(_training(spark, sf))))


def _click_model(spark: SparkSession, sf: str, marked: DataFrame | None = None) -> ctr_model.ClickModel:
    """The stored model of these files; the trained queries share one fit, in whatever session."""

    def fit() -> tuple[ctr_model.ClickModel, int]:
        rows = _marked(spark, sf) if marked is None else marked
        train = rows.filter(~F.col("is_test"))
        return ctr_model.fit(train), train.count()

    return model_store.get_or_fit(spark, _model_store(spark), _raw(spark, sf), fit)


def _sound(predictions: DataFrame) -> DataFrame:
    """The rows as the model saw them, and whether score and class are sound."""
    prob = F.col("predicted_prob")
    predicted = F.coalesce((F.col("predicted_clicked") == 1) == (prob >= 0.5), F.lit(False))
    return predictions.select(
        *[c for c in PREDICTIONS_SCHEMA.names if not c.startswith("predicted_")],
        F.coalesce(prob.between(0, 1), F.lit(False)).alias("score_sound"),
        predicted.alias("class_sound"),
    )


def _trained_predictions(spark: SparkSession, sf: str) -> DataFrame:
    marked = _marked(spark, sf)
    model = _click_model(spark, sf, marked)
    return _sound(ctr_model.predict(model, marked.filter("is_test")))


def _scored_from_store(spark: SparkSession, sf: str) -> DataFrame:
    """All impressions, scored by the stored model without a fit of their own."""
    _click_model(spark, sf)
    model = model_store.load(spark, _model_store(spark))
    return _sound(ctr_model.predict(model, _training(spark, sf)))


def _model_table(spark: SparkSession, sf: str) -> DataFrame:
    """The newest model of the store: the rows it was fitted to and how its inputs are scaled."""
    _click_model(spark, sf)
    newest = model_store.model_table(spark, _model_store(spark)).orderBy(F.desc("version")).limit(1)
    return newest.select("fit_rows", F.inline("scaled"))


def _trained_importance(spark: SparkSession, sf: str) -> DataFrame:
    """The features that the model ranks; shares of the whole, as they add up to 1."""
    found = ctr_model.feature_importance(spark, _click_model(spark, sf))
    total = found.agg(F.sum("importance").alias("total"))
    return found.select(
        "feature", (F.col("importance") >= 0).alias("sound"), total.scalar().alias("total")
    )


def _top_features(spark: SparkSession, sf: str) -> DataFrame:
    """The ten features that the stored model ranks highest, and whether they are just these.

    Ranked: not above the one before. Above: not below the features left out. All
    importances together are one.
    """
    every = ctr_model.feature_importance(spark, _click_model(spark, sf))
    top = reports.top_features(every, 10)
    left = every.join(top, "feature", "left_anti").agg(F.max("importance").alias("most"))
    total = every.agg(F.sum("importance").alias("total"))
    # Ten rows.
    ranked = Window.orderBy(F.desc("importance"), "feature")
    before = F.lag("importance").over(ranked)
    return top.select(
        F.row_number().over(ranked).alias("position"),
        F.col("feature").isin(*ctr_model.FEATURES).alias("known"),
        F.coalesce(F.col("importance") <= before, F.lit(True)).alias("ranked"),
        (F.col("importance") >= left.scalar()).alias("above"),
        total.scalar().alias("total"),
    )


def _feature_spread(spark: SparkSession, sf: str) -> DataFrame:
    """The model inputs that vary most against their mean over all training rows."""
    rows = _training(spark, sf)
    spread = rows.agg(
        *[
            ratio(F.stddev_pop(F.col(c).cast("double")), F.avg(F.col(c).cast("double"))).alias(c)
            for c in (*ctr_model.SCALED, *ctr_model.PLAIN)
        ]
    )
    named = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("importance")) for c in spread.columns]
    return reports.top_features(spread.select(F.inline(F.array(*named))), 4)


def _fitted_segments(trainer: str) -> Query:
    """Users with their features, and whether their cluster is one of four and the nearest."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        features = materialize(_features(spark, sf))
        scaled = segments.standardize(materialize(segments.model_input(features)))
        centers = segments.TRAINERS[trainer](scaled)
        near = segments.nearest_center(scaled, centers)
        distances = F.array(*segments._squared_distances(centers, segments.FEATURES))
        own = F.get(distances, F.col("user_cluster"))
        checked = near.select("user_id", (own <= F.array_min(distances)).alias("nearest"))
        return (
            segments.assign_segments(features, centers)
            .join(checked, "user_id")
            .withColumn("in_range", F.col("user_cluster").between(0, 3))
            .drop("user_cluster")
        )

    return run


def _minibatch_gain(spark: SparkSession, sf: str) -> DataFrame:
    """Four centres, and no more inertia after the mini-batches than with the seeds."""
    scaled = materialize(_scaled(spark, sf))
    seeds = segments.seed_centers(scaled)
    centers = segments.fit_centers_minibatch(scaled)
    before, after = (
        segments.inertia(segments.nearest_center(scaled, c)).first() for c in (seeds, centers)
    )
    return scaled.agg(F.count(F.lit(1)).alias("users")).select(
        "users",
        F.lit(len(centers)).alias("centers"),
        F.lit(after["inertia"] <= before["inertia"]).alias("improved"),
    )


def _quality_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Users that occur more than once in the impression log, and their rows."""
    return quality.not_unique(_staged(spark, sf)["impressions"], "user_id")


def _quality_unique_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """The same from digests per day: half of the month, then the other half."""
    lake, keys = work_path(spark, "lake"), work_path(spark, "keys")
    log = ingest.with_event_date(_staged(spark, sf)["impressions"])
    tables.write_layer(log, lake, "silver", "impressions", "event_date")
    log = tables.read_layer(spark, lake, "silver", "impressions")
    days = sorted((r[0] for r in log.select("event_date").distinct().collect()), key=str)
    for part in (days[: len(days) // 2], days[len(days) // 2 :]):
        daily_keys.check_days(log, "user_id", keys, part)
    return daily_keys.repeated_keys(log, "user_id", keys)


def _revenue_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue quartiles per format over some days, from sketches per day: whether the rank
    of each among all revenues of these days is as near as stated."""
    staged = _staged(spark, sf)
    formats = staged["campaigns"].select("campaign_id", "ad_format")
    sold = ingest.with_event_date(staged["conversions"]).join(formats, "campaign_id")
    kept = materialize(sketches.value_sketches(sold, "revenue", ["event_date", "ad_format"]), "sketches")
    some = F.col("event_date").between(*RANGE)
    found = sketches.sketched_quantiles(kept.filter(some), (0.25, 0.5, 0.75), ["ad_format"])
    values = sold.filter(some).select("ad_format", F.col("revenue").cast("double").alias("value"))
    return (
        values.join(F.broadcast(found), "ad_format")
        .groupBy("ad_format", "prob", "quantile", "n")
        .agg(F.count("value").alias("rows"), F.count_if(F.col("value") < F.col("quantile")).alias("below"), F.count_if(F.col("value") <= F.col("quantile")).alias("upto"))
        .select(
            "ad_format", "prob", "rows", (F.col("n") == F.col("rows")).alias("all_seen"),
            (
                (F.col("below") / F.col("rows") <= F.col("prob") + sketches.RANK_ERROR)
                & (F.col("upto") / F.col("rows") >= F.col("prob") - sketches.RANK_ERROR)
            ).alias("within"),
        )
    )


def _quality_not_null(spark: SparkSession, sf: str) -> DataFrame:
    """Users of the cleaned feed that lack a signup date."""
    users = silver(testdata.bronze_records(spark, sf, "users"), "users")
    return quality.null_rows(users, "signup_date")


def _quality_report(spark: SparkSession, sf: str) -> DataFrame:
    staged = dict(_staged(spark, sf))
    staged["campaign_summary"] = materialize(campaign_summary(staged), "mart")
    keys = [
        ("users", "user_id"),
        ("campaigns", "campaign_id"),
        ("impressions", "impression_id"),
        ("clicks", "click_id"),
        ("conversions", "conversion_id"),
        ("campaign_summary", "campaign_id"),
    ]
    checks = [(t, c, kind) for t, c in keys for kind in ("unique", "not_null")]
    return quality.check_report(staged, checks)


def _csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Campaigns out as CSV, then the path of a feed: CSV, messages, bronze, silver."""
    csv, topic = work_path(spark, "csv"), work_path(spark, "topic")
    tables.export_csv(_raw(spark, sf)["campaigns"], csv)
    landing.write_messages(landing.as_messages(landing.read_csv(spark, csv)), topic, "text")
    return silver(landing.to_bronze(landing.read_messages(spark, topic, "text")), "campaigns")


def _feed(spark: SparkSession, sf: str, entity: str) -> tuple[str, dict[str, str]]:
    """Records in six parts, the newest days first, and the options that read part by part.

    Second copies stand in the last part, records without a time in any. Each part is
    written by as many tasks as a shuffle has.
    """
    topic = work_path(spark, "topic")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    records = testdata.bronze_records(spark, sf, entity, with_copy=True)
    when = F.get_json_object("json_record", "$.timestamp").try_cast("timestamp")
    by_day = F.coalesce(31 - F.dayofmonth(when), F.pmod(F.xxhash64("json_record"), F.lit(30)))
    part = F.when(F.col("copy") == 2, 5).otherwise(F.least(F.floor(by_day / 6), F.lit(4)))
    placed = materialize(records.select(F.col("json_record").alias("value"), part.alias("part")))
    for number in range(6):
        rows = placed.filter(F.col("part") == number).select("value").repartition(files)
        landing.write_messages(rows, topic, "text")
    return topic, {"maxFilesPerTrigger": str(files)}


def _stream_silver(entity: str) -> Query:
    """The feed through bronze to silver, in micro-batches of two jobs."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        topic, some = _feed(spark, sf, entity)
        bronze, out = work_path(spark, "bronze"), work_path(spark, "silver")
        messages = landing.stream_messages(spark, topic, "text", some)
        ingest.land_bronze(messages, bronze, work_path(spark, "landing"))
        landed = landing.stream_messages(spark, bronze, "parquet", some)
        ingest.stream_silver(landed, entity, out, work_path(spark, "cleaning"))
        return ingest.read_silver(spark, entity, out)

    return run


def _stream_state(entity: str) -> Query:
    """The feed to silver by remembered digests: ten days recent, the days before compared."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        topic, some = _feed(spark, sf, entity)
        out = work_path(spark, "silver")
        bronze = landing.to_bronze(landing.stream_messages(spark, topic, "text", some))
        clock = F.lit("2024-01-31 00:00:00").cast("timestamp")
        how = {"horizon_hours": 240, "clock": clock}
        ingest.stream_silver_by_state(bronze, entity, out, work_path(spark, "cleaning"), **how)
        return ingest.read_silver(spark, entity, out)

    return run


def _stream_daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    """All days of the event stream, per kind of event."""
    kinds = testdata.EVENT_TYPES
    entity = F.coalesce(*[F.when(F.col("event_type") == v, k) for k, v in kinds.items()])
    source = testdata.stream_events(spark, sf)
    events = source.filter(F.col("event_type").isin(list(kinds.values()))).select(
        entity.alias("entity"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("revenue"),
    )
    out = work_path(spark, "daily")
    daily.stream_daily(events, out, work_path(spark, "days"), by=("entity",))
    return daily.read_daily(spark, out, by=("entity",))


RANGE = oracle_queries.RANGE


def _daily_report_range(spark: SparkSession, sf: str) -> DataFrame:
    """Some days of logs that are stored by day."""
    raw, root = _raw(spark, sf), work_path(spark, "lake")
    logs = []
    for log in LOGS:
        tables.write_layer(ingest.with_event_date(raw[log]), root, "silver", log, "event_date")
        logs.append(tables.read_layer(spark, root, "silver", log))
    return reports.daily_report(raw["campaigns"], *logs, *RANGE)


def _unparsed(spark: SparkSession, sf: str) -> DataFrame:
    return unparsed_values(testdata.bronze_records(spark, sf, "conversions"), "conversions")


def _rejected(spark: SparkSession, sf: str) -> DataFrame:
    """What the faulty conversion feed lost, and of which sale, where that can be read."""
    _, rejected = clean_and_rejected(testdata.bronze_records(spark, sf, "conversions"), "conversions")
    sale = F.get_json_object("json_record", "$.conversion_id").cast("double").cast("long")
    return rejected.select(sale.alias("conversion_id"), "column_name", "value", "reason")


def _forbid_negative(spark: SparkSession, sf: str) -> DataFrame:
    """Revenues after a refund of 50 that may not make them negative."""
    rows = _raw(spark, sf)["conversions"].withColumn("revenue", F.col("revenue") - 50)
    return repair_money(rows, "conversions", forbid_negative=True).select("conversion_id", "revenue")


def _publish_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Rows counted while the mart and the staged logs are written, and as read back."""
    staged, rows = _staged(spark, sf), []
    for name, df in {"campaign_summary": _mart(spark, sf), "clicks": staged["clicks"]}.items():
        path = work_path(spark, name)
        written = tables.publish(df, path, "parquet")
        back = tables.load_table(spark, path, "parquet")
        rows.append(
            back.agg(F.count(F.lit(1)).alias("read")).select(
                F.lit(name).alias("name"), F.lit(written).alias("written"), "read"
            )
        )
    return rows[0].union(rows[1])


def _replaced_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table that is replaced from itself: as its readers still see it, as it is, by number."""
    path = work_path(spark, "campaigns")
    versions.replace(_staged(spark, sf)["campaigns"], path, partition_by="ad_format")
    pinned = versions.read(spark, path)
    versions.replace(pinned.filter("ad_format = 'video'"), path, partition_by="ad_format")
    seen = {"pinned": pinned, "current": versions.read(spark, path), "first": versions.read(spark, path, 1)}
    rows = [
        df.agg(F.count(F.lit(1)).alias("campaigns"), F.sum("budget").alias("budget")).select(
            F.lit(name).alias("name"), "campaigns", "budget"
        )
        for name, df in seen.items()
    ]
    return rows[0].union(rows[1]).union(rows[2])


def _incremental_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The mart from counts per day: logs up to a day, then later days and late rows of one."""
    raw, staged = _raw(spark, sf), _staged(spark, sf)
    silver_of, counts = {log: work_path(spark, log) for log in LOGS}, work_path(spark, "counts")
    day = F.dayofmonth("timestamp")
    late = (day > 24) | ((day == 20) & (F.col("user_id") % 50 == 0))
    for batch, part in enumerate((~late, late)):
        for log, path in silver_of.items():
            rows = ingest.with_event_date(raw[log]).filter(part)
            ingest.overwrite_batch(rows, path, batch, ingest.DAY)
        incremental.update_counts(spark, silver_of, counts)
    return incremental.summary_from_counts(spark, counts, staged["campaigns"])


def _cached_result(spark: SparkSession, sf: str) -> DataFrame:
    """The mart's sums as stored, asked again, and renewed once they are too old."""
    root = work_path(spark, "results")
    by_format = lambda: _mart(spark, sf).groupBy("ad_format").agg(
        F.count(F.lit(1)).alias("campaigns"), F.sum("budget").alias("budget")
    )
    asked = []
    for step, age in (("stored", 300), ("again", 300), ("renewed", 0)):
        got = results.cached(by_format(), root, timedelta(seconds=age))
        number = versions.current(spark, f"{root}/{results.result_key(by_format())}").number
        asked.append(got.select(F.lit(step).alias("step"), F.lit(number).alias("version"), "*"))
    return asked[0].union(asked[1]).union(asked[2])


def _stored_model(spark: SparkSession, sf: str) -> DataFrame:
    """The mart under a name, kept in memory, and asked in SQL."""
    tables.register_model(tables.cache_result(_mart(spark, sf)), "adlake_mart")
    return tables.load_table(
        spark,
        "select ad_format, count(*) as campaigns, sum(budget) as budget from adlake_mart"
        " group by ad_format",
        "sql",
    )


def _optional_tables(spark: SparkSession, sf: str) -> DataFrame:
    """A table that exists and one that does not."""
    tables.register_model(_staged(spark, sf)["clicks"], "adlake_clicks")
    there = tables.load_optional(spark, "adlake_clicks", PREDICTIONS_SCHEMA)
    missing = tables.load_optional(spark, "adlake_nothing", PREDICTIONS_SCHEMA)
    count = F.count(F.lit(1)).alias("rows")
    return there.agg(count).select(F.lit("adlake_clicks").alias("name"), "rows").union(
        missing.agg(count).select(F.lit("adlake_nothing"), "rows")
    )


def _catalog_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Column lists of the staged tables, from the catalog."""
    staged = _staged(spark, sf)
    for name in ENTITIES:
        tables.register_model(staged[name], f"adlake_stg_{name}")
    listed = tables.column_listing(tables.catalog_columns(spark))
    return listed.filter(F.col("table_name").startswith("adlake_stg_")).select(
        "table_name", F.array_join("columns", ", ").alias("columns")
    )


def _queries() -> dict[str, Query]:
    named: dict[str, Query] = {}
    for entity in ENTITIES:
        named[f"silver_{entity}"] = _silver_query(entity)
        named[f"stg_{entity}"] = _staging_query(entity)
    named |= {
        # marts
        "campaign_performance": lambda spark, sf: campaign_performance(_staged(spark, sf)),
        "campaign_summary": _mart,
        # features
        "first_click": lambda spark, sf: feat.first_click(_staged(spark, sf)["clicks"]),
        "user_click_rate": _user_click_rate,
        "campaign_ctr_history": _campaign_ctr_history,
        "ctr_training_data": _training,
        "ctr_training_as_of": lambda spark, sf: feat.training_set_as_of(_staged(spark, sf)),
        "user_features": _features,
        "user_features_compat": lambda spark, sf: _features(spark, sf, compat=True),
        # campaign reports
        "kpi_overview": _on_mart(reports.kpi_overview),
        "filtered_summary": _on_mart(lambda m: reports.filter_campaigns(m, **FILTER)),
        "filtered_overview": _on_mart(
            lambda m: reports.kpi_overview(reports.filter_campaigns(m, **FILTER))
        ),
        "filter_values": _on_mart(reports.filter_values),
        "advertiser_rollup": _on_mart(reports.advertiser_rollup),
        "roi_region_format": _on_mart(reports.roi_by_region_format),
        "roi_grid": _on_mart(lambda m: reports.roi_grid(m, testdata.FORMATS)),
        "roi_quartiles": _on_mart(reports.roi_quartiles),
        "roi_vs_ctr": _on_mart(reports.roi_vs_ctr),
        "spend_vs_revenue": _on_mart(reports.spend_vs_revenue),
        "top_campaigns_revenue": _on_mart(reports.top_by_revenue),
        "top_campaigns_roi": _on_mart(reports.top_by_roi),
        "adhoc_top5_roi": _on_mart(lambda m: reports.top_by_roi(m, 5)),
        "campaign_table": _on_mart(reports.by_revenue),
        "campaign_bars": _on_mart(reports.campaign_bars),
        "pareto_revenue": _on_mart(reports.pareto),
        "funnel": _on_mart(reports.funnel),
        # daily reports
        "daily_impressions": lambda spark, sf: reports.daily_count(
            _raw(spark, sf)["impressions"], "impressions"
        ),
        "daily_clicks": lambda spark, sf: reports.daily_count(_raw(spark, sf)["clicks"], "clicks"),
        "daily_revenue": lambda spark, sf: reports.daily_revenue(_raw(spark, sf)["conversions"]),
        "daily_spend": lambda spark, sf: reports.daily_spend(_raw(spark, sf)["campaigns"]),
        "daily_report": _daily,
        "daily_ctr_percent": lambda spark, sf: reports.ctr_percent(_daily(spark, sf)),
        "adhoc_trend": lambda spark, sf: reports.revenue_spend_trend(_daily(spark, sf)),
        # scores
        "score_by_format_region": _on_scores(reports.score_by_format_region),
        "score_rollup": _on_scores(reports.score_hierarchy),
        "score_histogram": _on_scores(reports.score_histogram),
        "score_histogram_by_format": _on_scores(
            lambda p: reports.score_histogram(p, 30, "ad_format")
        ),
        "calibration": _on_scores(
            lambda p: reports.calibration(
                materialize(p.select("predicted_prob", "actual_clicked"))
            )
        ),
        "classification_report": _on_scores(ctr_model.classification_report),
        "roc_auc": _on_scores(ctr_model.roc_auc),
        "stratified_split": _split,
        "train_scaler": lambda spark, sf: ctr_model.scaler_statistics(_train_part(spark, sf)),
        "class_weight": lambda spark, sf: ctr_model.class_weight(_train_part(spark, sf)),
        # segments
        "standardized_features": lambda spark, sf: _scaled(spark, sf).select(
            "user_id", *segments.FEATURES
        ),
        "nearest_center": lambda spark, sf: segments.nearest_center(
            _scaled(spark, sf), CENTERS
        ).select("user_id", "user_cluster", "distance_sq"),
        "inertia": lambda spark, sf: segments.inertia(
            segments.nearest_center(_scaled(spark, sf), CENTERS)
        ),
        "minibatch_step": lambda spark, sf: segments.minibatch_step(
            _scaled(spark, sf), CENTERS, SEEN
        ),
        "cluster_summary": _on_segments(segments.cluster_summary),
        "cluster_ranks": _on_segments(
            lambda s: segments.rank_clusters(segments.cluster_summary(s)).select(
                "user_cluster", "total_revenue", "value_rank"
            )
        ),
        "segment_rollup": _on_segments(segments.segment_rollup),
        "segment_share": _on_clusters(segments.segment_share),
        "segment_value": _on_clusters(lambda users, summary: segments.segment_value(summary)),
        "segment_unpivot": _on_clusters(
            lambda users, summary: segments.segment_engagement(summary)
        ),
        "segment_top3": _on_segments(segments.top_clusters),
        "segment_region_device": _on_segments(segments.segment_region_device),
        "segment_kpis": _on_clusters(segments.segment_kpis),
        "adhoc_cluster_value": _on_segments(segments.clusters_by_value),
        # trained
        "ctr_predictions": _trained_predictions,
        "feature_importance": _trained_importance,
        "user_segments": _fitted_segments("parallel"),
        "user_segments_minibatch": _fitted_segments("minibatch"),
        "minibatch_training": _minibatch_gain,
        "scored_from_store": _scored_from_store,
        "model_table": _model_table,
        "top_features": _top_features,
        "feature_spread": _feature_spread,
        # quality and small models
        "quality_unique": _quality_unique,
        "quality_unique_by_day": _quality_unique_by_day,
        "revenue_sketches": _revenue_sketches,
        "quality_not_null": _quality_not_null,
        "quality_report": _quality_report,
        "union_all": lambda spark, sf: examples.with_null_id(
            _staged(spark, sf)["campaigns"].select(F.col("campaign_id").alias("id"))
        ),
        "equality_filter": _on_mart(lambda m: examples.equal_to(m, "ad_format", "video")),
        "safe_divide": _on_mart(
            lambda m: m.select(
                "campaign_id", safe_divide("total_revenue", "active_days").alias("value")
            )
        ),
        "preview": lambda spark, sf: tables.preview(
            _staged(spark, sf)["clicks"].orderBy("click_id"), 50
        ),
        "csv_feed": _csv_round_trip,
        "unparsed_values": _unparsed,
        "rejected_records": _rejected,
        "forbid_negative": _forbid_negative,
        # tables
        "daily_report_range": _daily_report_range,
        "publish_audit": _publish_audit,
        "replaced_table": _replaced_table,
        "incremental_mart": _incremental_mart,
        "cached_result": _cached_result,
        "stored_model": _stored_model,
        "optional_tables": _optional_tables,
        "catalog_columns": _catalog_columns,
        # streaming
        "stream_silver_clicks": _stream_silver("clicks"),
        "stream_silver_conversions": _stream_silver("conversions"),
        "stream_state_clicks": _stream_state("clicks"),
        "stream_state_users": _stream_state("users"),
        "stream_daily_counts": _stream_daily_counts,
    }
    return named


def _optional(module: str):
    """The module, or None where its folder or file is absent; other errors are raised."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as error:
        if error.name not in (module, module.rpartition(".")[0]):
            raise
        return None


_LLM = _optional("adlake.llm.queries")
# The pipeline is made of the operators of that subpackage.
_PIPELINE = _optional("corpus_pipeline") if _LLM else None


def _comparable(query: Query) -> Query:
    return lambda spark, sf: _plain(query(spark, sf))


def entry(spark: SparkSession) -> DataFrame:
    """The campaign summary at the smallest scale."""
    return _plain(_mart(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    named = {name: _comparable(query) for name, query in _queries().items()}
    if _LLM:
        named |= _LLM.queries()
    if _PIPELINE:
        named["pipeline"] = _PIPELINE.run
    return named


def oracle_sql() -> dict[str, str]:
    statements = oracle_queries.oracle_sql()
    if _LLM:
        statements |= _LLM.oracle_sql()
    if _PIPELINE and _PIPELINE.ORACLE_SQL:
        statements["pipeline"] = _PIPELINE.ORACLE_SQL
    return statements
