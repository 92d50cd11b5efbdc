"""VAL1-VAL12 (reference intents F1, F2; fixtures G5, G6)."""

from pyspark.sql import functions as F

from helpers import order, orders_df
from zonecast.operators import validate as V


def _reasons(spark, cfg, rows):
    return {r["order_id"]: r for r in V.with_reasons(orders_df(spark, rows), cfg).collect()}


def test_null_zone_is_missing_and_invalid(spark, cfg):
    # operators: VAL1, VAL7, VAL9
    # F1 + G6: schema reason, then the range group after ' | '
    r = _reasons(spark, cfg, [order("test-order-1", zone=None)])["test-order-1"]
    assert "Missing required field: zone_id" in r["schema_reason"]
    assert r["error_reason"] == "Missing required field: zone_id | Invalid zone_id: None"


def test_out_of_range_values(spark, cfg):
    # operators: VAL5, VAL6, VAL8
    # both range reasons, joined with '; '
    r = _reasons(spark, cfg, [order("test-order-2", value=-10.0, items=25)])["test-order-2"]
    assert "order_value is not positive: -10.0" in r["range_reason"]
    assert "items_count out of range [1, 20]: 25" in r["range_reason"]
    assert r["range_reason"] == ("order_value is not positive: -10.0; "
                                 "items_count out of range [1, 20]: 25")
    assert r["schema_reason"] is None


def test_null_order_value_fires_missing_and_not_numeric(spark, cfg):
    # operators: VAL1, VAL2, VAL8
    # VAL1 and VAL2 both fire; VAL5 is silent on an unparseable value
    r = _reasons(spark, cfg, [order("o", value=None)])["o"]
    assert r["error_reason"] == "Missing required field: order_value; order_value is not numeric"


def test_nan_is_not_numeric(spark, cfg):
    # operators: VAL2
    r = _reasons(spark, cfg, [order("o", value=float("nan"))])["o"]
    assert r["error_reason"] == "order_value is not numeric"


def test_clean_row_has_no_reason(spark, cfg):
    # operators: VAL9
    r = _reasons(spark, cfg, [order("ok", zone="Z3")])["ok"]
    assert r["error_reason"] is None


def test_string_inputs_follow_python_conversions(spark, cfg):
    # operators: VAL1, VAL2, VAL3, VAL4, VAL7
    # T11: '3.7' is not an integer, ' 3 ' is, blank is missing
    df = spark.createDataFrame(
        [("a", "Z1", "2026-01-01 00:00:00", "12.5", "3.7", "10"),
         ("b", "Z1", "2026-01-01 00:00:00", "12.5", " 3 ", "10"),
         ("c", " ", "2026-01-01 00:00:00", "abc", "3", "x")],
        "order_id string, zone_id string, timestamp string, order_value string, "
        "items_count string, delivery_time_mins string")
    got = {r["order_id"]: r["error_reason"] for r in V.with_reasons(df, cfg).collect()}
    assert got["a"] == "items_count is not integer"
    assert got["b"] is None
    assert got["c"] == ("Missing required field: zone_id; order_value is not numeric; "
                        "delivery_time_mins is not numeric | Invalid zone_id:  ")


def test_split_and_counts(spark, cfg):
    # operators: VAL10, VAL12
    rows = [order("a"), order("b", zone="Z9"), order("c", items=0), order("d", zone="Z2")]
    v = V.with_reasons(orders_df(spark, rows), cfg)
    assert sorted(r.order_id for r in V.clean_rows(v).collect()) == ["a", "d"]
    assert sorted(r.order_id for r in V.rejected_rows(v).collect()) == ["b", "c"]
    c = V.validation_counts(v).first()
    assert (c.total_rows, c.schema_invalid, c.range_invalid, c.clean_rows, c.rejected_rows) == \
        (4, 0, 2, 2, 2)


def test_dedupe_keeps_earliest_and_null_ids(spark, cfg):
    # operators: VAL10
    rows = [order("x", t="2026-01-01 10:00:00", value=2.0),
            order("x", t="2026-01-01 09:00:00", value=1.0),
            order(None, value=3.0), order(None, value=4.0)]
    out = V.dedupe_orders(orders_df(spark, rows)).collect()
    xs = [r for r in out if r.order_id == "x"]
    assert len(xs) == 1 and xs[0].order_value == 1.0
    assert sum(1 for r in out if r.order_id is None) == 2


def test_flags_coerced(spark, cfg):
    # operators: VAL11
    rows = [order("a", weekend=None, festival=None)]
    r = V.clean_rows(V.with_reasons(orders_df(spark, rows), cfg)).first()
    assert r.is_weekend is False and r.is_festival_day is False


def test_hot_duplicate_group_collapses(spark, cfg):
    # operators: VAL10
    # a third of the rows share one id: one survivor, no row lost elsewhere
    rows = [order("hot", t=f"2026-01-01 0{i % 10}:00:00") for i in range(30)]
    rows += [order(f"id{i}") for i in range(60)]
    out = V.dedupe_orders(orders_df(spark, rows))
    assert out.count() == 61
    assert out.where(F.col("order_id") == "hot").first().timestamp.hour == 0


def test_boolean_predicate_matches_reasons(spark, cfg):
    # operators: VAL10
    from helpers import SF_MID
    from zonecast.sources.adapters import raw_orders_from_testdata
    raw = raw_orders_from_testdata(spark, SF_MID, cfg)
    v = V.with_reasons(raw, cfg).withColumn("_ok", V.is_valid(cfg))
    assert v.where(F.col("_ok") != F.col("error_reason").isNull()).count() == 0
    assert V.clean_from_orders(raw, cfg).exceptAll(V.clean_rows(v.drop("_ok"))).count() == 0


def test_flag_counts_match_text_counts(spark, cfg):
    # operators: VAL10, VAL12
    from helpers import SF_MID
    from zonecast.sources.adapters import raw_orders_from_testdata
    raw = raw_orders_from_testdata(spark, SF_MID, cfg)
    by_text = V.validation_counts(V.with_reasons(raw, cfg)).first().asDict()
    by_flag = V.with_flags(raw, cfg).agg(*V.flag_counts()[:5]).first().asDict()
    assert by_text == by_flag
    clean, rejected = V.split_flagged(V.with_flags(raw, cfg), cfg)
    v = V.with_reasons(raw, cfg)
    assert clean.exceptAll(V.clean_rows(v)).count() == 0
    assert rejected.exceptAll(V.rejected_rows(v)).count() == 0
