"""Rows, frames and folders that several test modules share."""

import datetime as dt

from zonecast.sources.schemas import RAW_ORDERS

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def ts(text: str) -> dt.datetime:
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def order(oid="o1", zone="Z1", t="2026-01-01 12:00:00", value=500.0, items=3,
          delivery=15.0, weekend=False, weather="sunny", festival=False):
    return (oid, zone, ts(t) if isinstance(t, str) else t, value, items, delivery, weekend,
            weather, festival)


def orders_df(spark, rows):
    return spark.createDataFrame(rows, RAW_ORDERS)
