"""Commits by several writers, key summaries, hour-count deltas, expiry."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from helpers import order, orders_df, ts
from zonecast.operators import features as FE
from zonecast.plans import jobs as J
from zonecast.sources import commits, keys
from zonecast.sources.commits import CommitLog
from zonecast.sources.store import Store


# ---- commits ----------------------------------------------------------------------------

def test_the_slower_of_two_writers_builds_again(spark, tmp_root):
    # operators: SNK3, SNK11, SNK12, SRC6
    mine, other = CommitLog(spark, f"{tmp_root}/log"), CommitLog(spark, f"{tmp_root}/log")
    seen = []

    def build(last):
        seen.append(last)
        if len(seen) == 1:  # the other writer takes the number meanwhile
            other.commit(lambda _last: {"who": "other"})
        return {"who": "mine", "after": last and last["who"]}

    assert mine.commit(build)["seq"] == 2
    assert [s and s["who"] for s in seen] == [None, "other"]
    assert [(c["seq"], c["who"]) for c in mine.all()] == [(1, "other"), (2, "mine")]
    assert mine.last()["after"] == "other"


def test_many_writers_lose_no_commit(spark, tmp_root):
    # operators: SNK3
    def work():
        log = CommitLog(spark, f"{tmp_root}/log")
        for _ in range(5):
            log.commit(lambda last: {"count": (last["count"] if last else 0) + 1, "at": ts("2026-01-01 00:00:00")})

    threads = [threading.Thread(target=work) for _ in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    log = CommitLog(spark, f"{tmp_root}/log")
    assert [c["count"] for c in log.all()] == list(range(1, 21)) and log.last()["at"] == ts("2026-01-01 00:00:00")
    assert log.frame("seq long, count long").agg(F.sum("count")).first()[0] == 210


def test_an_unfinished_commit_is_waited_for_and_then_passed_over(spark, tmp_root, monkeypatch):
    # operators: SNK3
    log = CommitLog(spark, f"{tmp_root}/log")
    log.commit(lambda _last: {"n": 1})
    log.files.create(log._path(2), "")
    assert log.last()["n"] == 1
    monkeypatch.setattr(commits, "ABANDONED_S", 1.0)
    assert log.commit(lambda last: {"n": last["n"] + 1})["seq"] == 3
    assert [c["seq"] for c in log.all()] == [1, 3]


def test_two_feature_jobs_at_once_keep_both_results(spark, cfg, tmp_root, monkeypatch):
    # operators: SNK3, AG1
    st = Store(spark, tmp_root, cfg)
    J.ingest_batch(st, cfg, orders_df(spark, [order("a", t="2026-01-01 10:00:00")]), ts("2026-01-02 00:00:00"), ts("2026-01-01 00:00:00"))
    counts, calls = Store.zone_hour_counts, []

    def slow(self, *args):
        calls.append(args)
        if len(calls) == 1:  # a second batch, and a feature job over it, are finished meanwhile
            J.ingest_batch(st, cfg, orders_df(spark, [order("b", t="2026-01-01 12:00:00")]), ts("2026-01-02 01:00:00"), ts("2026-01-01 00:00:00"))
            J.run_features(st, cfg, ts("2026-01-02 02:00:00"))
        return counts(self, *args)

    monkeypatch.setattr(Store, "zone_hour_counts", slow)
    J.run_features(st, cfg, ts("2026-01-02 03:00:00"))
    assert len(calls) == 3 and [c["upto"] for c in st.log("features").all()] == [2, 2]
    got = st.read_table("features").where("order_count > 0").select("timestamp").collect()
    assert sorted(r.timestamp.hour for r in got) == [10, 12]


# ---- key summaries ------------------------------------------------------------------------

def test_summaries_miss_no_id_and_hit_few_others(spark):
    # operators: SNK1
    ids = spark.range(30_000).select(F.concat(F.lit("order-"), F.col("id")).alias("order_id"),
                                     F.date_add(F.lit("2026-01-01"), (F.col("id") % 3).cast("int")).alias("dt"))
    bits = keys.summarise(ids, "order_id", "dt").cache()
    assert {r.blocks for r in bits.collect()} == {16} and bits.count() == 48
    own = keys.hits(bits, ids.select("order_id"), "order_id", "dt")
    assert own.join(ids, ["order_id", "dt"]).count() == 30_000
    other = spark.range(100_000).select(F.concat(F.lit("other-"), F.col("id")).alias("order_id"))
    assert own.count() == 30_000 and keys.hits(bits, other, "order_id", "dt").count() == 0
    assert keys.hits(bits.limit(0), other, "order_id", "dt").count() == 0


def test_summaries_hold_the_bits_of_their_ids(spark):
    # operators: SNK1
    days = {dt.date(2026, 1, 1): 3, dt.date(2026, 1, 2): 300}  # one block each; few words, and most words
    ids = spark.createDataFrame([(f"o{d.day}-{k}", d) for d, n in days.items() for k in range(n)], "order_id string, dt date")
    want = {d: set() for d in days}
    for r in ids.withColumn("set", keys.positions(F.col("order_id"))).collect():
        want[r.dt] |= set(r.set)
    rows = keys.summarise(ids, "order_id", "dt").collect()
    assert len(rows) == 2 and all(len(r.bits) == keys.WORDS for r in rows)
    assert {r.dt: {64 * w + b for w, word in enumerate(r.bits) for b in range(64) if word >> b & 1} for r in rows} == want


def test_summaries_shuffle_ids_by_block_and_not_their_bits(spark):
    # operators: SNK1
    ids = spark.createDataFrame([(f"o{k}", dt.date(2026, 1, 1 + k % 3)) for k in range(50)], "order_id string, dt date")
    bits = keys.summarise(ids, "order_id", "dt")
    bits.collect()
    plan = bits._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    shuffles = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert len(shuffles) == 2  # the count a date, and the ids by block: a date isn't one task's work
    assert any("blocks#" in x and "block#" in x for x in shuffles)
    assert not any("_groupingexpression" in x for x in shuffles)  # the bits' words


def test_ids_are_not_gathered_by_a_small_block(spark, monkeypatch):
    # operators: SNK1
    monkeypatch.setattr(keys, "BROADCAST_ROWS", 4, raising=False)
    ids = spark.range(30_003).select(
        F.concat(F.lit("order-"), F.col("id")).alias("order_id"),
        F.when(F.col("id") < 3, F.date_add(F.lit("2026-01-01"), F.col("id").cast("int")))
        .otherwise(F.to_date(F.lit("2026-01-09"))).alias("dt"))
    bits = keys.summarise(ids, "order_id", "dt").cache()  # three dates of one block, one of 64
    assert sorted(r.blocks for r in bits.select("blocks").distinct().collect()) == [1, 64]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = keys.hits(bits.where("blocks = 1"), ids.select("order_id"), "order_id", "dt")
        assert sorted(r.order_id for r in small.collect()) == ["order-0", "order-1", "order-2"]
        plan = small._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        both = keys.hits(bits, ids.select("order_id"), "order_id", "dt")
        assert sorted(both.collect()) == sorted(ids.select("order_id", "dt").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        bits.unpersist()


def test_a_batch_without_repeats_opens_no_key_partition(spark, cfg, tmp_root, monkeypatch):
    # operators: SNK1, SRC1
    st = Store(spark, tmp_root, cfg)
    days = range(1, 9)
    for k in range(2):
        rows = [order(f"o{k}-{d}", t=f"2026-01-{d:02d} 10:00:00") for d in days]
        J.ingest_batch(st, cfg, orders_df(spark, rows), ts(f"2026-02-0{k + 1} 00:00:00"), ts("2026-01-01 00:00:00"))
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "order_id string")
    assert st.known_ids(ids(*(f"new{k}" for k in range(2000))))[1] == []
    known, opened = st.known_ids(ids("o0-3", "o1-3", "o1-7", "new"))
    assert opened == [dt.date(2026, 1, 3), dt.date(2026, 1, 7)]
    assert sorted(r.order_id for r in known.collect()) == ["o0-3", "o1-3", "o1-7"]
    scan = next(x for x in known._jdf.queryExecution().executedPlan().toString().split("\n")
                if "order_keys" in x and "PartitionFilters" in x)
    assert "dt" in scan.split("PartitionFilters: [")[1].split("]")[0]
    # A false hit costs reading only.
    monkeypatch.setattr(keys, "hits", lambda s, i, key, part: i.select(key).join(F.broadcast(s.select(part).distinct())))
    known, opened = st.known_ids(ids("o0-3", "new"))
    assert len(opened) == 8 and [r.order_id for r in known.collect()] == ["o0-3"]
    monkeypatch.undo()
    assert st.compact_key_summaries(dt.date(2026, 1, 5)) == 4
    assert st.read_table("key_summaries").where("dt = DATE '2026-01-03'").select("batch").distinct().count() == 1
    assert sorted(r.order_id for r in st.known_ids(ids("o0-3", "o1-3", "o1-7", "x"))[0].collect()) == ["o0-3", "o1-3", "o1-7"]


# ---- hour counts --------------------------------------------------------------------------

def _batches(spark, st, cfg, n, day=lambda k: 1 + k):
    for k in range(n):
        rows = [order(f"b{k}-{i}", zone=f"Z{1 + i % 3}", t=f"2026-01-{day(k):02d} {i % 24:02d}:10:00",
                      weather="rainy" if (i + k) % 3 == 0 else "sunny", festival=i % 5 == 0) for i in range(40)]
        J.ingest_batch(st, cfg, orders_df(spark, rows), ts(f"2026-02-{1 + k:02d} 00:00:00"), ts("2026-01-01 00:00:00"))


def test_features_read_counts_and_never_orders(spark, cfg, tmp_root, monkeypatch):
    # operators: AG1, SNK3
    st = Store(spark, tmp_root, cfg)
    _batches(spark, st, cfg, 3)
    read = Store.read_table

    def guarded(self, name):
        assert name != "clean_orders"
        return read(self, name)

    monkeypatch.setattr(Store, "read_table", guarded)
    J.run_features(st, cfg, ts("2026-02-10 00:00:00"))
    J.run_features(st, cfg, ts("2026-02-11 00:00:00"))
    plan = st.zone_hour_counts(3, ts("2026-01-02 00:00:00"))._jdf.queryExecution().toString()
    assert "clean_orders" not in plan and "zone_hour_deltas" in plan
    monkeypatch.undo()
    full = FE.build_features(st.read_table("clean_orders"), cfg)
    assert sorted(st.read_table("features").collect()) == sorted(full.collect())


def test_a_run_writes_only_the_dates_it_changes(spark, cfg, tmp_root):
    # operators: SNK3, AG1
    st = Store(spark, tmp_root, cfg)
    rows = [order(f"o{k}", t=f"2026-01-{1 + k % 20:02d} 10:00:00") for k in range(60)]
    J.ingest_batch(st, cfg, orders_df(spark, rows), ts("2026-02-01 00:00:00"), ts("2026-01-01 00:00:00"))
    J.run_features(st, cfg, ts("2026-02-10 00:00:00"))
    before = st.last_commit("features")["parts"]
    late = [order("late", t="2026-01-18 05:00:00")]
    J.ingest_batch(st, cfg, orders_df(spark, late), ts("2026-02-21 00:00:00"), ts("2026-01-01 00:00:00"))
    J.run_features(st, cfg, ts("2026-02-22 00:00:00"))
    after = st.last_commit("features")["parts"]
    assert {d for d in after if after[d] != before[d]} == {"2026-01-18", "2026-01-19", "2026-01-20"}
    full = FE.build_features(st.read_table("clean_orders"), cfg)
    assert sorted(st.read_table("features").collect()) == sorted(full.collect())


def test_compacted_counts_equal_the_deltas(spark, cfg, tmp_root):
    # operators: AG1, SNK3
    small = cfg.with_(compact_every=2, keep_versions=1)
    st = Store(spark, tmp_root, small)
    for k in range(3):
        _batches(spark, st, small, 1, day=lambda _k: 1 + k // 2)
        rows = [order(f"x{k}", t=f"2026-01-0{1 + k} 03:00:00")]
        J.ingest_batch(st, small, orders_df(spark, rows), ts("2026-02-20 00:00:00"), ts("2026-01-01 00:00:00"))
        J.run_features(st, small, ts(f"2026-03-0{1 + k} 00:00:00"))
    upto = st.last_commit("zone_hour_counts")["upto"]
    assert upto >= 4 and len(st.list_dirs(st.path("zone_hour_deltas"))) == 6 - upto
    want = FE.zone_hour_partials(st.read_table("clean_orders"))
    got = st.zone_hour_counts(6)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


# ---- expiry -------------------------------------------------------------------------------

def test_old_versions_expire_unless_they_are_leased(spark, cfg, tmp_root):
    # operators: SNK3, SRC3
    st = Store(spark, tmp_root, cfg)
    rows = lambda k: FE.build_features(orders_df(spark, [order(f"o{k}", t=f"2026-01-{1 + k:02d} 10:00:00")]), cfg)
    st.overwrite_versioned("features", rows(0), ts("2026-01-01 00:00:00"))
    with st.leased("features") as mine:
        for k in range(1, 7):
            st.overwrite_versioned("features", rows(k), ts("2026-01-01 00:00:00"))
            st.expire("features", 2)
        versions = [d for d in st.list_dirs(st.path("features")) if d.startswith("v=")]
        assert len(versions) == 3 and len(st.log("features").all()) == 3  # two newest and the leased one
        assert {r.timestamp.day for r in mine.collect()} == {1}
    st.expire("features", 2)
    assert len([d for d in st.list_dirs(st.path("features")) if d.startswith("v=")]) == 2
    assert {r.timestamp.day for r in st.read_table("features").collect()} == {7}
    assert st.files.list(f"{st.path('features')}/_commits_leases", dirs=False) == []


def test_a_dead_reader_s_lease_ends(spark, cfg, tmp_root):
    # operators: SNK3
    log = CommitLog(spark, f"{tmp_root}/log")
    for n in range(3):
        log.commit(lambda _last, n=n: {"n": n})
    log.files.create(f"{log._leases()}/dead.json", '{"seq": 1, "until": 5}')
    assert [c["seq"] for c in log.live(1)] == [3]
    with pytest.raises(RuntimeError), log.lease():
        raise RuntimeError
    assert log.files.list(log._leases(), dirs=False) == []


# ---- flags and the time index ---------------------------------------------------------------

def _predictions(spark, rows):
    return spark.createDataFrame(
        [(z, ts(h), 9.0, "NORMAL", ts(g), k) for k, (z, h, g) in enumerate(rows)],
        "zone_id string, forecast_hour timestamp_ntz, predicted_order_count double, confidence_flag string, "
        "generated_at timestamp_ntz, prediction_id long")


def test_flags_are_merged_into_the_touched_dates_only(spark, cfg, tmp_root, monkeypatch):
    # operators: SNK6, JN9
    st = Store(spark, tmp_root, cfg)
    st.append("predictions", _predictions(spark, [
        ("Z1", "2026-01-03 01:00:00", "2026-01-02 23:00:00"), ("Z1", "2026-01-03 01:00:00", "2026-01-03 00:00:00"),
        ("Z2", "2026-01-03 01:00:00", "2026-01-03 00:00:00"), ("Z1", "2026-01-01 05:00:00", "2026-01-01 04:00:00")]))
    other = set(f for f, _ in st.files.list(f"{st.path('predictions')}/dt=2026-01-01", dirs=False))
    alerts = spark.createDataFrame([("Z1", ts("2026-01-03 01:00:00"))], "zone_id string, forecast_hour timestamp_ntz")
    merge = Store.merge_flags
    monkeypatch.setattr(Store, "merge_flags", lambda self: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        st.flag(alerts, ts("2026-01-03 00:30:00"))
    high = lambda: sorted((r.zone_id, r.generated_at.day) for r in st.read_predictions().where(
        "confidence_flag = 'HIGH_DEMAND'").collect())
    assert len(st.pending_flags()) == 1 and high() == [("Z1", 2), ("Z1", 3)]  # joined on read until merged
    monkeypatch.setattr(Store, "merge_flags", merge)
    st.flag(alerts, ts("2026-01-03 00:30:00"))  # the retry
    assert st.pending_flags() == [] and st.read_table("prediction_flags").count() == 1
    assert high() == [("Z1", 2), ("Z1", 3)] and st.read_predictions().count() == 4
    assert "prediction_flags" not in st.read_predictions()._jdf.queryExecution().toString()
    assert set(f for f, _ in st.files.list(f"{st.path('predictions')}/dt=2026-01-01", dirs=False)) == other
    st.append("predictions", _predictions(spark, [("Z1", "2026-01-03 01:00:00", "2026-01-03 00:45:00")]))
    assert high() == [("Z1", 2), ("Z1", 3)]  # as an UPDATE: later rows need an alert of their own
    st.flag(alerts, ts("2026-01-03 00:50:00"))
    assert high() == [("Z1", 2), ("Z1", 3), ("Z1", 3)]


def _scanned(df):
    """Rows that the scan gave, before any filter of Spark's own."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    leaves = execution.executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_a_drift_read_skips_row_groups(spark, cfg, tmp_root):
    # operators: SRC5, FLT6
    st = Store(spark, tmp_root, cfg.with_(row_group_bytes=32 << 10))
    orders = spark.range(57_600).select(
        F.concat(F.lit("o"), "id").alias("order_id"), F.concat(F.lit("Z"), F.col("id") % 5 + 1).alias("zone_id"),
        (F.lit(ts("2026-01-01 00:00:00")).cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") % 1440 * 60).cast("decimal(18,6)"))).alias("timestamp"),
        F.rand(1).alias("order_value"))
    st.append("clean_orders", orders)
    assert st.read_table("clean_orders").columns[-1] == "dt" and "ts_us" not in st.read_table("clean_orders").columns
    since = ts("2026-01-01 20:00:00")
    indexed = st.read_indexed("clean_orders")
    by_index = indexed.where(F.col("ts_us") >= F.unix_micros(F.lit(since).cast("timestamp_ntz").cast("timestamp")))
    plain = indexed.where(F.col("timestamp") >= F.lit(since).cast("timestamp_ntz"))
    assert by_index.count() == plain.count() == 9_600
    assert _scanned(plain) == 57_600 and 9_600 <= _scanned(by_index) < 30_000
