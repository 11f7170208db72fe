"""Equi-joins that survive hot keys: measured broadcast, else salting of the hot keys only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from locusflow.session import materialize

#: A side is broadcast only when its measured size is at most this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024
#: A join key with more left rows than this is split over several tasks.
ROWS_PER_TASK = 2_000_000
#: Buckets in which keys are counted before they are counted one by one.
KEY_BUCKETS = 4_096
#: Hash-table cost per broadcast row on top of the column bytes.
ROW_OVERHEAD = 48


def _column_bytes(field: T.StructField) -> Column | None:
    """Measured bytes of one column, or None when the type has no cheap exact measure."""
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(field.name), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.NumericType, T.BooleanType)):
        return F.greatest(F.size(field.name), F.lit(0)) * 8 + 24
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return None
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int | None:
    """Bytes of ``df`` found by one distributed aggregate (no rows reach the driver)."""
    widths = [_column_bytes(f) for f in df.schema.fields]
    if any(w is None for w in widths):
        return None
    row = sum(widths, F.lit(ROW_OVERHEAD))
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("b")).first()["b"]


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """True when the measured size of ``df`` allows a broadcast.  Runs one aggregate job."""
    limit = BROADCAST_BYTES if limit is None else limit
    if limit <= 0:
        return False
    size = measured_bytes(df)
    return size is not None and size <= limit


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint when its measured size allows it, else unchanged."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def hot_keys(df: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys holding more than ``rows_per_task`` rows, with the number of salts each needs.

    At most ``rows / rows_per_task`` keys qualify, so the result stays small however
    large ``df`` is.  Keys are counted by buckets of their hash first; only those in
    buckets that hold enough rows are counted one by one (eager).
    """
    bucket = F.pmod(F.xxhash64(*on), F.lit(KEY_BUCKETS))
    full = df.groupBy(bucket.alias("__bucket")).count().filter(F.col("count") > rows_per_task).select("__bucket").toArrow()
    if not full.num_rows:
        return df.limit(0).select(*on, F.lit(1).alias("__salts"))
    return (
        df.filter(bucket.isin(full["__bucket"].to_pylist()))
        .groupBy(*on)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > rows_per_task)
        .select(*on, F.ceil(F.col("__n") / F.lit(rows_per_task)).cast("int").alias("__salts"))
    )


def _match(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, condition: Column | None) -> DataFrame:
    """Join on equal keys plus a condition; the right side arrives with ``__k_`` key names."""
    test = F.lit(True) if condition is None else condition
    for key in on:
        test = (F.col(key) == F.col(f"__k_{key}")) & test
    return left.join(right, test, how).drop(*[f"__k_{key}" for key in on])


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
    salt_on: Sequence[str] | None = None,
    broadcast_limit: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    may_salt: bool = True,
) -> DataFrame:
    """Equi-join (``inner``, ``left``, ``left_semi`` or ``left_anti``) safe against hot left keys.

    The right side is broadcast when its measured size allows.  Otherwise both
    sides are shuffled, and a left key above ``rows_per_task`` rows is spread over
    salts while the right rows of that key alone are copied once per salt.  A left
    row meets every right row exactly once whatever its salt, so the result does
    not depend on either choice.  The salt hashes ``salt_on`` (default: all left
    columns that can be hashed) and the input partition, so copies of one row
    spread as well.  Column names of both sides must differ apart from ``on``.
    ``may_salt=False`` is for a right side known to be small, with a broadcast hint of its own.
    """
    left = left.filter(" AND ".join(f"{k} IS NOT NULL" for k in on)) if how in ("inner", "left_semi") else left
    renamed = right.withColumnsRenamed({k: f"__k_{k}" for k in on})
    if left.isStreaming or not may_salt:  # Every micro-batch is joined as it comes; there is nothing to count beforehand.
        return _match(left, renamed, on, how, condition)
    if fits_broadcast(renamed, broadcast_limit):
        return _match(left, F.broadcast(renamed), on, how, condition)

    hot = materialize(hot_keys(left.select(*on), on, rows_per_task))
    if hot.isEmpty():
        return _match(left, renamed, on, how, condition)

    hot_side = broadcast_if_small(hot)
    hashed = salt_on or [f.name for f in left.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salted_left = (
        left.join(hot_side, list(on), "left")
        .withColumn(
            "__salt",
            F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), F.coalesce("__salts", F.lit(1))).cast("int"),
        )
        .drop("__salts")
    )
    copies = F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)
    salted_right = (
        right.join(hot_side, list(on), "left")
        .withColumn("__k___salt", F.explode(copies))
        .drop("__salts")
        .withColumnsRenamed({k: f"__k_{k}" for k in on})
    )
    joined = _match(salted_left, salted_right, [*on, "__salt"], how, condition)
    return joined.select(*[c for c in joined.columns if c != "__salt"])
