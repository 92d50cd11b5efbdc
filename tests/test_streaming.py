"""SM1-SM3: stream results, late-data bound, duplicate suppression."""

import os

from helpers import order, orders_df, ts
from zonecast.plans import catalog_jobs as CJ
from zonecast.sources.schemas import RAW_ORDERS
from zonecast.streaming import ingest_stream as S


def _write_files(spark, root, batches):
    for i, rows in enumerate(batches):
        orders_df(spark, rows).coalesce(1).write.parquet(f"{root}/src/part={i:03d}")


def test_hourly_counts_drop_rows_behind_the_watermark(spark, cfg, tmp_root):
    # operators: SM3, AG6
    # Spark filters late input against the watermark of the batch before
    # (multi-operator semantics), so the late row comes one batch after
    # the watermark has moved past its window.
    _write_files(spark, tmp_root, [
        [order("a", t="2026-01-01 10:10:00"), order("b", t="2026-01-01 10:20:00"),
         order("c", t="2026-01-01 12:30:00")],                      # watermark -> 10:30
        [order("d", t="2026-01-01 10:40:00")],                      # its window is still open
        [order("late", t="2026-01-01 09:50:00")],                   # behind 10:30: dropped
        [order("e", t="2026-01-01 14:00:00")],                      # watermark -> 12:00
    ])
    stream = S.read_stream(spark, f"{tmp_root}/src", RAW_ORDERS, max_files=1)
    S.drain_append(S.hourly_counts_stream(stream, "2 hours"), f"{tmp_root}/out", f"{tmp_root}/ckpt")
    got = {(r.zone_id, r.hour_timestamp): r.order_count
           for r in spark.read.parquet(f"{tmp_root}/out").collect()}
    assert got[("Z1", ts("2026-01-01 10:00:00"))] == 3
    assert ("Z1", ts("2026-01-01 09:00:00")) not in got
    # windows still inside the bound are held back in append mode
    assert ("Z1", ts("2026-01-01 14:00:00")) not in got


def test_stream_dedup_within_bound(spark, cfg, tmp_root):
    # operators: SM2
    _write_files(spark, tmp_root, [
        [order("x", t="2026-01-01 10:00:00"), order("y", t="2026-01-01 10:05:00")],
        [order("x", t="2026-01-01 10:30:00", value=9.0), order("z", t="2026-01-01 10:40:00")],
    ])
    stream = S.read_stream(spark, f"{tmp_root}/src", RAW_ORDERS, max_files=1)
    S.drain_append(S.dedupe_stream(stream, "1 hour"), f"{tmp_root}/out", f"{tmp_root}/ckpt")
    got = sorted((r.order_id, r.order_value) for r in spark.read.parquet(f"{tmp_root}/out").collect())
    assert got == [("x", 500.0), ("y", 500.0), ("z", 500.0)]


def test_validated_stream_splits_like_batch(spark, cfg, tmp_root):
    # operators: SM1, VAL6, VAL7
    _write_files(spark, tmp_root, [[order("ok"), order("bad", zone="Z7")], [order("ok2", items=0)]])
    stream = S.read_stream(spark, f"{tmp_root}/src", RAW_ORDERS, max_files=1)
    S.validate_stream(spark, stream, cfg, f"{tmp_root}/clean", f"{tmp_root}/rej", f"{tmp_root}/ckpt")
    assert sorted(r.order_id for r in spark.read.parquet(f"{tmp_root}/clean").collect()) == ["ok"]
    rej = {r.order_id: r.error_reason for r in spark.read.parquet(f"{tmp_root}/rej").collect()}
    assert rej == {"bad": "Invalid zone_id: Z7", "ok2": "items_count out of range [1, 20]: 0"}


def test_stream_into_store_is_replay_safe(spark, cfg, tmp_root):
    # operators: SM1, SNK1, SNK2, VAL10
    import datetime as dt
    from zonecast.sources.store import Store
    _write_files(spark, tmp_root, [[order("a"), order("b", zone="Z9")],
                                   [order("c", t="2026-01-02 08:00:00"), order("a")]])
    st = Store(spark, f"{tmp_root}/wh", cfg)
    as_of = lambda _b: dt.datetime(2026, 1, 3)
    for run in range(2):  # the second run replays every file under a new checkpoint
        stream = S.read_stream(spark, f"{tmp_root}/src", RAW_ORDERS, max_files=1)
        S.ingest_stream_to_store(st, cfg, stream, f"{tmp_root}/ckpt{run}", as_of)
        assert sorted(r.order_id for r in st.read_table("clean_orders").collect()) == ["a", "c"]
        assert [r.order_id for r in st.read_table("validation_errors").collect()] == ["b"]


def test_late_rows_are_kept_and_reconciled(spark, cfg, tmp_root):
    # operators: SM3
    files = [[order("a", t="2026-01-01 10:05:00"), order("b", t="2026-01-01 09:50:00")],
             [order("c", t="2026-01-01 20:00:00"), order("d", t="2026-01-01 10:30:00")],
             [order("e", t="2026-01-01 10:45:00"), order("f", t="2026-01-01 17:10:00"), order("g", t="2026-01-01 18:59:00")]]
    for k, rows in enumerate(files):
        orders_df(spark, rows).coalesce(1).write.parquet(f"{tmp_root}/src/part={k}")
    for replay in range(2):  # under a new checkpoint all batches run again
        S.count_with_late_rows(S.read_stream(spark, f"{tmp_root}/src", RAW_ORDERS, max_files=1), cfg,
                               f"{tmp_root}/out", f"{tmp_root}/ckpt{replay}")
        late = sorted(r.order_id for r in spark.read.schema(RAW_ORDERS).parquet(f"{tmp_root}/out/late").collect())
        assert late == ["e", "f"]
        got = {r.hour_timestamp.hour: (r.order_count, r.late_count) for r in S.reconciled_counts(spark, f"{tmp_root}/out").collect()}
        assert got == {9: (1, 0), 10: (3, 1), 17: (1, 1), 18: (1, 0), 20: (1, 0)}


def test_a_delivery_is_written_as_one_file_a_core_and_batch(spark, tmp_root):
    # operators: SM1
    rows = orders_df(spark, [order(f"o{k}", zone="Z1") for k in range(500)])  # one zone: no split by it
    cores = spark.sparkContext.defaultParallelism
    assert CJ._write_batches(rows, 2, f"{tmp_root}/src") == cores
    assert len([f for f in os.listdir(f"{tmp_root}/src") if f.endswith(".parquet")]) == 2 * cores
    assert sorted(spark.read.parquet(f"{tmp_root}/src").collect()) == sorted(rows.collect())


def test_late_orders_and_the_others_are_told_apart_row_by_row(spark):
    # operators: AG1
    rows = [order(f"o{k}", t="2024-01-29 10:00:00") for k in range(40)]
    rows += rows[:20] + [order("no-time", t=None), order(None, t="2024-01-29 10:00:00"), order(None, t=None)]
    df = orders_df(spark, rows)
    rest = df.where(~CJ._is_late())
    want, got = df.exceptAll(CJ._late(df)).collect(), rest.collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and 0 < len(got) < len(rows)
    assert "Aggregate" not in rest._jdf.queryExecution().executedPlan().toString()
