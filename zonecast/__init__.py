"""zonecast: hourly per-zone order-demand analytics on Spark.

Ingest with rule-based validation, a dense zone-hour feature grid with
lag/rolling features, boosted-tree training with a seasonal-naive gate,
recursive multi-step forecasts, drift/high-demand monitoring and the
report queries on top. Every operator is a DataFrame -> DataFrame
function; I/O lives in ``zonecast.sources.store`` and the jobs in
``zonecast.plans``.
"""

from zonecast.config import Config, DEFAULT_CONFIG, TEST_CONFIG

__all__ = ["Config", "DEFAULT_CONFIG", "TEST_CONFIG"]
