"""Order validation: predicates -> reasons -> routing (VAL1-VAL12).

Every rule is a (condition, text) pair of row expressions. Reason text is
``concat_ws`` over the texts of the rules that hold (it skips NULLs), so
one projection produces it; the clean split that feeds the features uses
the same conditions as a plain boolean predicate and builds no strings.
No UDF, no row loop, no join: everything runs inside whole-stage codegen
in the scan stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.config import (NULL_TEXT, REASON_GROUP_SEPARATOR, REASON_INVALID_ZONE,
                             REASON_MISSING, REASON_NOT_INTEGER, REASON_NOT_NUMERIC,
                             REASON_NOT_POSITIVE, REASON_OUT_OF_RANGE, REASON_SEPARATOR,
                             REQUIRED_FIELDS, Config)

GROUP_SEP, MERGE_SEP = REASON_SEPARATOR, REASON_GROUP_SEPARATOR

REASON_COLUMNS = ("schema_reason", "range_reason", "error_reason")


def _num(c: str) -> Column:
    return F.col(c).try_cast("double")


def _int(c: str) -> Column:
    return F.col(c).try_cast("int")


Rule = tuple[Column, Column]  # (condition, reason text when it holds)


def missing_rules(fields=REQUIRED_FIELDS) -> list[Rule]:
    """VAL1: NULL, or blank after trim, per required field in order."""
    return [(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""),
             F.lit(REASON_MISSING.format(c))) for c in fields]


def type_rules() -> list[Rule]:
    """VAL2-VAL4: values that do not convert (NaN counts as not numeric, T10)."""
    v, n, d = _num("order_value"), _int("items_count"), _num("delivery_time_mins")
    return [
        (v.isNull() | F.isnan(v), F.lit(REASON_NOT_NUMERIC.format("order_value"))),
        (n.isNull(), F.lit(REASON_NOT_INTEGER.format("items_count"))),
        (d.isNull() | F.isnan(d), F.lit(REASON_NOT_NUMERIC.format("delivery_time_mins"))),
    ]


def range_rules(cfg: Config) -> list[Rule]:
    """VAL5-VAL7: unparseable numerics are silent here; NULL zone is invalid."""
    v, n, z = _num("order_value"), _int("items_count"), F.col("zone_id")
    return [
        (v <= 0, F.format_string(REASON_NOT_POSITIVE.replace("{}", "%s"), v.cast("string"))),
        ((n < cfg.items_min) | (n > cfg.items_max),
         F.format_string(REASON_OUT_OF_RANGE.format(cfg.items_min, cfg.items_max, "%s"),
                         n.cast("string"))),
        (z.isNull() | ~z.isin(list(cfg.zones)),
         F.format_string(REASON_INVALID_ZONE.replace("{}", "%s"),
                         F.coalesce(z.cast("string"), F.lit(NULL_TEXT)))),
    ]


def _texts(rules: list[Rule]) -> list[Column]:
    return [F.when(cond, text) for cond, text in rules]


def missing_reasons(fields=REQUIRED_FIELDS) -> list[Column]:
    return _texts(missing_rules(fields))


def type_reasons() -> list[Column]:
    return _texts(type_rules())


def range_reasons(cfg: Config) -> list[Column]:
    return _texts(range_rules(cfg))


def _any(rules: list[Rule]) -> Column:
    conds = [F.coalesce(c, F.lit(False)) for c, _ in rules]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def schema_invalid(cfg: Config) -> Column:
    """Some VAL1-VAL4 rule fires (schema_reason would be non-NULL)."""
    return _any(missing_rules() + type_rules())


def range_invalid(cfg: Config) -> Column:
    """Some VAL5-VAL7 rule fires (range_reason would be non-NULL)."""
    return _any(range_rules(cfg))


def is_valid(cfg: Config) -> Column:
    """True exactly when no rule fires (error_reason would be NULL): a pure
    boolean predicate, so the clean split builds no reason strings."""
    return ~(schema_invalid(cfg) | range_invalid(cfg))


FLAG_COLUMNS = ("_schema_bad", "_range_bad")


def with_flags(orders: DataFrame, cfg: Config) -> DataFrame:
    """Two booleans per row; counters and routing need nothing else."""
    return orders.withColumns({"_schema_bad": schema_invalid(cfg),
                               "_range_bad": range_invalid(cfg)})


def flag_counts() -> list[Column]:
    """VAL12 from the boolean flags (same numbers as from the texts)."""
    bad = F.col("_schema_bad") | F.col("_range_bad")
    return [F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col("_schema_bad")).alias("schema_invalid"),
            F.count_if(F.col("_range_bad")).alias("range_invalid"),
            F.count_if(~bad).alias("clean_rows"),
            F.count_if(bad).alias("rejected_rows"),
            F.max("timestamp").alias("max_timestamp")]


def split_flagged(flagged: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """VAL10 on a flagged frame: clean rows without any text, rejected rows
    with their reasons (built only for them)."""
    bad = F.col("_schema_bad") | F.col("_range_bad")
    clean = coerce_flags(flagged.where(~bad).drop(*FLAG_COLUMNS))
    rejected = rejected_rows(with_reasons(flagged.where(bad).drop(*FLAG_COLUMNS), cfg))
    return clean, rejected


def clean_from_orders(orders: DataFrame, cfg: Config) -> DataFrame:
    """VAL10 (clean side) straight from orders, without reason text."""
    return coerce_flags(orders.where(is_valid(cfg)))


def _join(sep: str, parts: list[Column]) -> Column:
    """VAL8: join the non-NULL reasons of one group; '' -> NULL."""
    return F.nullif(F.concat_ws(sep, *parts), F.lit(""))


def with_reasons(orders: DataFrame, cfg: Config) -> DataFrame:
    """VAL1-VAL9: add schema_reason, range_reason and error_reason.

    error_reason is NULL exactly for clean rows; otherwise schema reasons
    come first, joined to range reasons with ' | ' (VAL9). The original's
    key-wise merge of two reason maps (JN7) is unnecessary: both groups
    are columns of the same row.
    """
    schema_r = _join(GROUP_SEP, missing_reasons() + type_reasons())
    range_r = _join(GROUP_SEP, range_reasons(cfg))
    return (orders
            .withColumns({"schema_reason": schema_r, "range_reason": range_r})
            .withColumn("error_reason",
                        _join(MERGE_SEP, [F.col("schema_reason"), F.col("range_reason")])))


def dedupe_orders(orders: DataFrame, key: str = "order_id",
                  order_by: str = "timestamp") -> DataFrame:
    """Primary-key semantics (T14): one row per non-NULL order_id.

    Keeps the earliest row, ties broken by the remaining values in column
    order. Duplicates are usually rare, so only they pay for the pick:
    a hash count over the id column alone finds the duplicated ids (map-side
    partial counts, so a hot id collapses per task); unique rows pass an
    anti-join against that id set (broadcast by AQE when its measured size
    is small, so the batch itself is not shuffled); the duplicated rows
    take the earliest row with ``min(struct)``, also combined map-side.
    Rows without an id are kept as they are (they are rejected by VAL1).
    """
    rest = [c for c in orders.columns if c not in (key, order_by)]
    keyed = orders.where(F.col(key).isNotNull())
    dup_ids = (keyed.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
               .where(F.col("_n") > 1).select(key))
    unique = keyed.join(dup_ids, key, "left_anti")
    picked = (keyed.join(dup_ids, key, "left_semi")
              .groupBy(key)
              .agg(F.min(F.struct(order_by, *rest)).alias("_row"))
              .select(key, *[F.col(f"_row.{c}").alias(c) for c in [order_by, *rest]]))
    no_key = orders.where(F.col(key).isNull())
    cols = orders.columns
    return unique.select(*cols).unionByName(picked.select(*cols)).unionByName(no_key.select(*cols))


def row_key(columns: list[str]) -> Column:
    """A null-safe hash of the row's values: NULL equals NULL, and a NULL in
    one column isn't the same as in another."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\\0")) for c in columns])


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_n``: 1, 2, ... among rows of one key, in two levels:
    counts a task and key, their prefix sums a key, and local numbers. No
    task gets all rows of a key, however many there are. Written once, so
    that both levels see the same tasks."""
    from zonecast.session import materialize  # noqa: PLC0415

    at = F.monotonically_increasing_id()  # the task in the high bits, the row in the low 33
    placed = materialize(rows.withColumn("_at", at), "numbered").withColumn("_task", F.shiftright("_at", 33))
    before = Window.partitionBy(key).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(key, "_task").agg(F.count(F.lit(1)).alias("_rows"))
               .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows"))
    local = F.row_number().over(Window.partitionBy(key, "_task").orderBy("_at"))
    return (placed.withColumn("_local", local).join(offsets, [key, "_task"])
            .withColumn("_n", F.col("_before") + F.col("_local")).drop("_at", "_task", "_before", "_local"))


def with_error_id(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Identity of a rejected row: its values and its number among equal
    rows, so a retry finds it and true repeats stay apart."""
    return (numbered(rows.withColumn("_key", row_key(columns)), "_key")
            .withColumn("error_id", F.xxhash64("_key", F.col("_n").cast("int"))).drop("_key", "_n"))


def coerce_flags(df: DataFrame, cols=("is_weekend", "is_festival_day")) -> DataFrame:
    """VAL11: boolean flags, NULL -> false."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in cols})


def clean_rows(validated: DataFrame) -> DataFrame:
    """VAL10 (clean side); the routing look-up into the invalid set (JN8)
    is a filter on the row's own reason."""
    out = validated.where(F.col("error_reason").isNull()).drop(*REASON_COLUMNS)
    return coerce_flags(out)


def rejected_rows(validated: DataFrame) -> DataFrame:
    """VAL10 (quarantine side)."""
    out = validated.where(F.col("error_reason").isNotNull()).drop("schema_reason", "range_reason")
    return coerce_flags(out)


def validation_counts(validated: DataFrame) -> DataFrame:
    """VAL12: total, schema-invalid, range-invalid, clean, rejected in one pass."""
    return validated.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("schema_reason").isNotNull()).alias("schema_invalid"),
        F.count_if(F.col("range_reason").isNotNull()).alias("range_invalid"),
        F.count_if(F.col("error_reason").isNull()).alias("clean_rows"),
        F.count_if(F.col("error_reason").isNotNull()).alias("rejected_rows"),
    )


def validate(orders: DataFrame, cfg: Config, dedupe: bool = True) -> DataFrame:
    """Dedupe (optional) + reasons: the single validated batch plan."""
    base = dedupe_orders(orders) if dedupe else orders
    return with_reasons(base, cfg)
