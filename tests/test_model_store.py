"""Models that outlive their session."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from adlake.plans import ctr_model, model_store
from adlake.plans import features as feat
from adlake.sources import versions
from helpers import rows, staged_frames

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SETTINGS = {"rounds": 3, "depth": 2}


@pytest.fixture(scope="module")
def training(spark):
    return feat.training_set(staged_frames(spark))


@pytest.fixture(scope="module")
def model(training):
    return ctr_model.fit(training, **SETTINGS)


def _scores(df):
    return {tuple(r) for r in df.select("impression_id", "user_id", "predicted_prob").collect()}


def test_save_and_load(spark, tmp_path, training, model):
    path = str(tmp_path / "m")
    assert model_store.save(spark, path, model, 40, "inputs", SETTINGS) == 1
    loaded = model_store.load(spark, path)
    assert _scores(ctr_model.predict(loaded, training)) == _scores(ctr_model.predict(model, training))
    assert rows(ctr_model.feature_importance(spark, loaded)) == rows(ctr_model.feature_importance(spark, model))
    assert rows(loaded.statistics) == rows(model.statistics)


def test_another_session_scores_alike(spark, tmp_path, training, model):
    path, data, out = (str(tmp_path / n) for n in ("m", "rows", "scores"))
    model_store.save(spark, path, model, 40)
    training.write.parquet(data)
    code = (
        "from adlake.session import build_session\n"
        "from adlake.plans import ctr_model, model_store\n"
        "spark = build_session('other', 'local[2]', **{'spark.ui.enabled': 'false'})\n"
        f"model = model_store.load(spark, {path!r})\n"
        f"ctr_model.predict(model, spark.read.parquet({data!r})).write.parquet({out!r})\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=HERE, timeout=300, capture_output=True)
    assert _scores(spark.read.parquet(out)) == _scores(ctr_model.predict(model, training))


def test_models_are_listed(spark, tmp_path, model):
    path = str(tmp_path / "m")
    model_store.save(spark, path, model, 40, "one", SETTINGS)
    assert model_store.save(spark, path, model, 41, "two") == 2
    listed = model_store.model_table(spark, path).collect()
    assert [(r["version"], r["fit_rows"], r["inputs"]) for r in listed] == [(1, 40, "one"), (2, 41, "two")]
    assert listed[0]["settings"] == '{"depth": 2, "rounds": 3}'
    assert sorted(tuple(s) for s in listed[0]["scaled"]) == rows(model.statistics)
    with pytest.raises(LookupError):
        model_store.load(spark, path, 3)
    with pytest.raises(LookupError):
        model_store.load(spark, str(tmp_path / "none"))


def test_fitted_once_per_inputs(spark, tmp_path, model):
    path, source = str(tmp_path / "m"), str(tmp_path / "source")
    spark.range(3).write.parquet(source)
    fits = []

    def fit():
        fits.append(1)
        return model, 40

    def ask(settings=SETTINGS):
        return model_store.get_or_fit(spark, path, {"t": spark.read.parquet(source)}, fit, settings)

    ask(), ask()
    assert len(fits) == 1
    ask({"rounds": 9})
    assert len(fits) == 2
    # The same path with other rows.
    spark.range(5).write.mode("overwrite").parquet(source)
    ask()
    assert len(fits) == 3 and len(versions.versions(spark, path)) == 3


def test_fingerprints_follow_the_files(spark, tmp_path):
    path = str(tmp_path / "a b")
    spark.range(10).repartition(3).write.parquet(path)
    frame = lambda: {"t": spark.read.parquet(path).filter(F.col("id") > 2)}
    first = versions.fingerprint(spark, frame())
    assert first == versions.fingerprint(spark, frame()) and len(first) == 64
    assert first != versions.fingerprint(spark, {"u": frame()["t"]})
    spark.range(1).write.mode("append").parquet(path)
    assert first != versions.fingerprint(spark, frame())
    assert versions.fingerprint(spark, {}) == versions.fingerprint(spark, {})
