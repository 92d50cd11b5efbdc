"""Jobs, store, streams and the driver contract (fixtures G7, G15, F5)."""

import datetime as dt
import os
import sys

import pytest
from pyspark.sql import functions as F

from helpers import SF_MID, SF_SMALL, order, orders_df, ts
from zonecast.plans import jobs as J
from zonecast.sources.adapters import raw_orders_from_testdata
from zonecast.sources.store import Store

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import oracle_check  # noqa: E402


def test_watermark_read_and_advance(spark, cfg, tmp_root):
    # operators: SRC1, SNK1, SNK2, SNK11, AG19, VAL10
    # Only rows after the watermark are read; the new watermark is the
    # newest event time, including a rejected row.
    st = Store(spark, tmp_root, cfg)
    wm = ts("2026-01-01 10:00:00")
    rows = [order("before", t="2026-01-01 09:00:00"), order("at", t="2026-01-01 10:00:00"),
            order("after", t="2026-01-01 11:00:00"),
            order("bad-latest", zone="Z9", t="2026-01-01 12:00:00")]
    st.append("raw_orders", orders_df(spark, rows))
    st.save_watermark("raw_orders", wm, ts("2026-01-01 10:30:00"))
    out = J.run_ingest(st, cfg, ts("2026-01-01 13:00:00"))
    assert (out["total_rows"], out["clean_rows"], out["rejected_rows"]) == (2, 1, 1)
    assert st.watermark("raw_orders", cfg.initial_watermark) == ts("2026-01-01 12:00:00")
    assert [r.order_id for r in st.read_table("clean_orders").collect()] == ["after"]


def test_every_new_row_is_read(spark, cfg):
    # operators: SRC1, TK2
    rows = [order("a", t="2026-01-01 01:00:00"), order("b", t="2026-01-01 02:00:00"), order("c", t=None),
            order("old", t="2025-12-31 23:00:00")]
    out = J.read_new_orders(orders_df(spark, rows), ts("2026-01-01 00:00:00"))
    assert sorted(r.order_id for r in out.collect()) == ["a", "b", "c"]


def test_resent_order_and_untimed_rows_are_kept_once(spark, cfg, tmp_root):
    # operators: SNK1, SNK2, SRC1, VAL1, VAL10
    st = Store(spark, tmp_root, cfg)
    first = [order("a", t="2026-01-05 10:00:00"), order("x", t=None), order(None, t=None), order(None, t=None),
             order(None, t="2026-01-05 09:00:00"), order("u", t=None, zone="Z1")]
    second = [order("a", t="2026-01-08 10:00:00"), order("b", t="2026-01-08 11:00:00"), order("y", t=None)]
    counts = []
    for k, rows in enumerate((first, second)):
        st.append("raw_orders", orders_df(spark, rows))
        for retry in range(2):
            counts.append(J.run_ingest(st, cfg, ts(f"2026-01-{9 + k:02d} 0{retry}:00:00"))["total_rows"])
    assert counts == [6, 0, 3, 0]
    assert sorted((r.order_id, r.timestamp.day) for r in st.read_table("clean_orders").collect()) == [("a", 5), ("b", 8)]
    bad = sorted(str(r.order_id) for r in st.read_table("validation_errors").collect())
    assert bad == ["None", "None", "None", "u", "x", "y"]
    assert all("timestamp" in r.error_reason for r in st.read_table("validation_errors").where("timestamp IS NULL").collect())


@pytest.mark.parametrize("step", ["key_summaries", "clean_orders", "order_keys", "write_delta", "validation_errors",
                                  "commit_batch"])
def test_failed_batch_is_completed_by_its_retry(spark, cfg, tmp_root, monkeypatch, step):
    # operators: SNK1, SNK2, SNK9, AG1
    st = Store(spark, tmp_root, cfg)
    st.append("raw_orders", orders_df(spark, [order("a"), order("bad", zone="Z9")]))

    def failing(method):
        def call(self, name, *args, **more):
            out = None
            if step not in ("commit_batch", name):  # an append fails after its rows were written
                return method(self, name, *args, **more)
            if step != "commit_batch":
                out = method(self, name, *args, **more)
            raise OSError(f"lost {out}")
        return call

    for name in ("append", "_append_dated", "commit_batch", "write_delta"):
        if step in ("write_delta", "commit_batch"):
            if name == step:
                monkeypatch.setattr(Store, name, lambda self, *a: (_ for _ in ()).throw(OSError("lost")))
        elif name in ("append", "_append_dated"):
            monkeypatch.setattr(Store, name, failing(getattr(Store, name)))
    with pytest.raises(OSError):
        J.run_ingest(st, cfg, ts("2026-01-02 00:00:00"))
    monkeypatch.undo()
    J.run_ingest(st, cfg, ts("2026-01-02 01:00:00"))
    assert [r.order_id for r in st.read_table("clean_orders").collect()] == ["a"]
    ids = spark.createDataFrame([("a",), ("b",)], "order_id string")
    assert [r.order_id for r in st.known_ids(ids)[0].collect()] == ["a"]
    assert [r.rows for r in st.zone_hour_counts(1).collect()] == [1]
    assert st.read_table("validation_errors").count() == 1
    assert sorted(r.status for r in st.read_table("pipeline_runs").collect()) == ["FAILED", "SUCCESS"]


def test_state_follows_commits_not_run_times(spark, cfg, tmp_root):
    # operators: SNK3, SNK11, SNK12, SRC6
    st = Store(spark, tmp_root, cfg)
    times = [ts("2026-01-02 00:00:00"), ts("2026-01-02 00:00:00"), ts("2026-01-01 00:00:00")]
    for k, t in enumerate(times):
        version = st.overwrite_versioned("features", st.empty("features"), t)
        assert st.current_version("features") == version
        st.set_model_pointer(f"m{k}", t)
        assert st.model_pointer() == f"m{k}"
        st.save_watermark("raw_orders", ts(f"2026-01-0{k + 3} 00:00:00"), t)
        assert st.watermark("raw_orders", cfg.initial_watermark) == ts(f"2026-01-0{k + 3} 00:00:00")
    st.save_watermark("raw_orders", ts("2025-01-01 00:00:00"), ts("2027-01-01 00:00:00"))
    assert st.watermark("raw_orders", cfg.initial_watermark) == ts("2026-01-05 00:00:00")


def test_drift_reads_only_the_window_partitions(spark, cfg, tmp_root):
    # operators: JN4, FLT6, ML7
    from zonecast.operators import monitor as MON
    st = Store(spark, tmp_root, cfg)
    rows = [order(f"o{d}", t=f"2026-01-{d:02d} 10:00:00") for d in range(1, 9)]
    st.append("clean_orders", orders_df(spark, rows).withColumn("ingested_at", F.lit(None)))
    pairs = MON.drift_pairs(st.empty("predictions"), st.read_table("clean_orders"), ts("2026-01-08 12:00:00"), cfg)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "items_count" not in x and "clean_orders" in x)
    assert "dt" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_training_without_features_is_a_failure(spark, cfg, tmp_root):
    # operators: ML6, ML7, SNK9
    st = Store(spark, tmp_root, cfg)
    try:
        J.run_training(st, cfg, ts("2026-01-01 00:00:00"), f"{tmp_root}/models")
        raise AssertionError("expected a failure")
    except ValueError:
        assert [r.status for r in st.read_table("pipeline_runs").collect()] == ["FAILED"]


def test_idempotent_append(spark, cfg, tmp_root):
    # operators: SNK1
    # The same batch twice adds nothing the second time
    st = Store(spark, tmp_root, cfg)
    clean = orders_df(spark, [order("a"), order("b")]).withColumn("ingested_at", F.lit(None))
    st.append("clean_orders", clean, key=["order_id"], since=ts("2026-01-01 00:00:00"))
    st.append("clean_orders", clean, key=["order_id"], since=ts("2026-01-01 00:00:00"))
    assert st.read_table("clean_orders").count() == 2


def test_end_to_end_jobs(spark, cfg, tmp_root):
    # operators: SRC1, SRC2, SRC3, SRC4, SRC5, SRC6, SNK1, SNK2, SNK3, SNK4, SNK5, SNK7, SNK8, SNK10, SNK12, ML1, ML2, ML3, ML4, ML5
    st = Store(spark, f"{tmp_root}/wh", cfg)
    st.append("raw_orders", raw_orders_from_testdata(spark, SF_MID, cfg))
    as_of = dt.datetime(2024, 1, 31, 1, 0)
    first = J.run_ingest(st, cfg, as_of)
    assert (first["clean_rows"], first["rejected_rows"]) == (7075, 2925)
    assert J.run_ingest(st, cfg, as_of + dt.timedelta(hours=1))["total_rows"] == 0
    J.run_features(st, cfg, as_of)
    v1 = st.read_table("features").orderBy("zone_id", "timestamp").collect()
    J.run_features(st, cfg, as_of + dt.timedelta(minutes=5), incremental=True)
    v2 = st.read_table("features").orderBy("zone_id", "timestamp").collect()
    assert v1 == v2 and len(v1) == 3600
    with_model = J.run_training(st, cfg, as_of, f"{tmp_root}/models", max_iter=5)
    assert with_model["trained"]
    assert J.run_predictions(st, cfg, as_of, f"{tmp_root}/models") == 10
    runs = {r.dag_name: r.status for r in st.read_table("pipeline_runs").collect()}
    assert set(runs.values()) == {"SUCCESS"} and len(runs) == 4


def test_prediction_job_without_model_logs_failure(spark, cfg, tmp_root):
    # operators: SRC6, SNK9
    st = Store(spark, tmp_root, cfg)
    try:
        J.run_predictions(st, cfg, ts("2026-01-01 00:00:00"), f"{tmp_root}/models")
        raise AssertionError("expected a failure")
    except FileNotFoundError:
        pass
    r = st.read_table("pipeline_runs").first()
    assert (r.dag_name, r.status, r.rows_processed) == ("generate_predictions", "FAILED", 0)


def test_model_beats_seasonal_naive(spark, cfg):
    # operators: ML1, ML2, ML3, ML4, ML5, AG8, AG9, AG10, AG11, FLT1, FLT2
    # F5 in spirit: the learned model is promoted over the seasonal-naive baseline
    from zonecast.operators import model as ML
    from zonecast.plans import catalog as C
    feats = C.features(spark, SF_MID).cache()
    model, _tr, val = ML.train(feats, cfg, max_iter=10)
    m = ML.evaluate_model(model, val).first()
    assert m.mape < m.baseline_mape and m.promoted


def test_entry_and_catalog(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "lag_168h" in df.columns
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    from zonecast.plans import catalog
    assert set(catalog.QUERIES) <= set(sql)


def test_differential_small(spark):
    # operators: VAL1, VAL9, WN1, WN7, ML8, ML7, RP5
    """A few registered queries against their DuckDB SQL at sf0.001."""
    import duckdb
    import __spark_entry__ as E
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    for name in ("validation_reasons", "feature_table", "forecast_linear", "drift_decision",
                 "dag_status"):
        s = E.queries()[name](spark, SF_SMALL).toPandas()
        d = con.execute(E.oracle_sql()[name]).df()
        assert sorted(s.columns) == sorted(d.columns), name
        assert len(s) == len(d), name
        assert oracle_check._rows(s) == oracle_check._rows(d), name


def test_training_skips_on_too_little_history(spark, cfg, tmp_root):
    # operators: ML6, ML7, SNK8
    # ML6: below the minimum rows the run is skipped and logged as SUCCESS with 0
    st = Store(spark, f"{tmp_root}/wh", cfg)
    st.append("raw_orders", raw_orders_from_testdata(spark, SF_SMALL, cfg))
    as_of = dt.datetime(2024, 1, 31, 1, 0)
    J.run_ingest(st, cfg, as_of)
    J.run_features(st, cfg, as_of)
    out = J.run_training(st, cfg.with_(min_train_rows=10**6), as_of, f"{tmp_root}/models", max_iter=2)
    assert out["trained"] is False and "not enough rows" in out["skipped"]
    assert out["decision"]["reason"] == "Triggered: No existing model"
    r = st.read_table("pipeline_runs").where(F.col("dag_name") == "model_training").first()
    assert (r.status, r.rows_processed) == ("SUCCESS", 0)


def test_quality_gate_on_high_volume_hours(spark, cfg):
    # operators: FLT3, ML3, ML4, AG10
    # F5 (the original's end-to-end gate): on validation hours with at least
    # 15 orders the learned model's MAPE is below 20 and below seasonal naive.
    from zonecast.operators import metrics as MET
    from zonecast.operators import model as ML
    from zonecast.plans import catalog as C
    feats = C.features(spark, "/root/testdata/sf0.1").cache()
    model, _tr, _val = ML.train(feats, cfg, max_iter=50)
    m = MET.evaluate(ML.score(model, MET.quality_rows(feats, cfg)), baseline="lag_168h").first()
    assert m.n_rows > 0
    assert m.mape < 20.0 and m.mape < m.baseline_mape


def test_two_batches_incremental_equals_full(spark, cfg, tmp_root):
    # operators: SRC1, SNK1, SNK3, SNK11, AG19
    from zonecast.operators import features as FE
    st = Store(spark, f"{tmp_root}/wh", cfg)
    raw = raw_orders_from_testdata(spark, SF_MID, cfg)
    cut = ts("2024-01-15 12:00:00")
    st.append("raw_orders", raw.where(F.col("timestamp") < cut))
    first = J.run_ingest(st, cfg, ts("2024-01-15 13:00:00"))
    J.run_features(st, cfg, ts("2024-01-15 13:15:00"))
    st.append("raw_orders", raw.where(F.col("timestamp") >= cut))
    second = J.run_ingest(st, cfg, ts("2024-01-31 01:00:00"))
    assert first["total_rows"] + second["total_rows"] == 10000
    assert st.read_table("clean_orders").count() == 7075
    J.run_features(st, cfg, ts("2024-01-31 01:15:00"), incremental=True)
    inc = st.read_table("features")
    full = FE.build_features(st.read_table("clean_orders"), cfg)
    assert inc.count() == full.count() == 3600
    assert inc.exceptAll(full).count() == 0


def test_prediction_job_retry_is_idempotent(spark, cfg, tmp_root):
    # operators: SNK4, SNK5
    st = Store(spark, f"{tmp_root}/wh", cfg)
    st.append("raw_orders", raw_orders_from_testdata(spark, SF_SMALL, cfg))
    as_of = dt.datetime(2024, 1, 31, 1, 0)
    J.run_ingest(st, cfg, as_of)
    J.run_features(st, cfg, as_of)
    J.run_training(st, cfg.with_(min_train_rows=1), as_of, f"{tmp_root}/models", max_iter=2)
    J.run_predictions(st, cfg, as_of, f"{tmp_root}/models")
    J.run_predictions(st, cfg, as_of, f"{tmp_root}/models")  # retried run, same as_of
    assert st.read_table("predictions").count() == 10


def test_failed_reload_keeps_previous_version(spark, cfg, tmp_root):
    # operators: SNK3 (T32: a failed reload publishes nothing)
    from zonecast.operators import features as FE
    st = Store(spark, f"{tmp_root}/wh", cfg)
    good = FE.build_features(orders_df(spark, [order("a"), order("b", zone="Z2")]), cfg)
    st.overwrite_versioned("features", good, ts("2026-01-01 01:00:00"))
    before = sorted(st.read_table("features").collect())
    bad = good.withColumn("order_count", F.lit("not a number").cast("int"))  # fails at write
    try:
        st.overwrite_versioned("features", bad, ts("2026-01-01 02:00:00"))
        raise AssertionError("expected the write to fail")
    except AssertionError:
        raise
    except Exception:  # noqa: BLE001
        pass
    assert sorted(st.read_table("features").collect()) == before
