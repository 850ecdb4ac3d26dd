"""Distributed selection of order statistics (behind O25 and O26).

The value at a given place of a group's sorted values is found by radix
selection: values become order-preserving 64-bit codes, a group's rows are
counted by the leading 16 bits of their codes, the prefix sums of these counts
name the one bucket that holds the place, and only that bucket's rows go to
the next 16 bits. A window over a group then never holds more than 65,536
rows, however many distinct values the group has, and the counting before it
combines on every task. All levels are part of one plan; nothing runs while it
is built, and no step depends on the order in which rows arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RADIX_BITS = 16
# A quantity of a declared domain no wider than this is selected in one window a group.
WINDOW_BITS = 23

# Bits of the codes by type; a type that is not here has no code.
_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "date": 32, "bigint": 64, "timestamp": 64, "float": 64, "double": 64}


def code_bits(kind: T.DataType) -> int | None:
    """How many bits the order-preserving code of a type has; None without one."""
    if isinstance(kind, T.DecimalType):
        return 64 if kind.precision <= 18 else None
    return _BITS.get(kind.simpleString())


def order_code(value: Column, kind: T.DataType) -> Column:
    """A BIGINT that orders as ``value`` does and differs for different values."""
    if isinstance(kind, T.DecimalType):
        return (value.cast(f"decimal({kind.precision + 1},{kind.scale})") * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # The bits of a double order like whole numbers once the negative ones are turned round; both
        # zeros are one value, and NaN comes last.
        exact = F.when(value == 0, F.lit(0.0)).otherwise(value.cast("double"))
        bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), exact).cast("bigint")
        return F.when(bits < 0, bits.bitwiseXOR(F.lit(0x7FFFFFFFFFFFFFFF))).otherwise(bits)
    return value.cast("bigint")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null keys are one group, as in GROUP BY."""
    cond = F.lit(True)
    for i, n in enumerate(names):
        cond = cond & left[n].eqNullSafe(right[f"__same{i}"])
    return cond


def nth_values(values: DataFrame, keys: Sequence[str], value: str, weight: str, nth: Column,
               domain_bits: int | None = None) -> DataFrame:
    """The value at place ``nth`` of each group, with the group's size.

    ``values`` holds one row for each group (``keys``) and distinct value, and
    how many rows it stands for (``weight``, above 0). ``nth`` is an expression
    over ``keys`` and ``__nn``, the sum of the group's non-null weights, and
    lies in 1 .. ``__nn``. Returns ``keys``, ``__v`` and ``__nn``; a group
    whose values are all NULL has NULL and 0.

    ``domain_bits`` says that the values lie in a domain of 2 ** domain_bits
    numbers; up to ``WINDOW_BITS`` that bounds a group's distinct values, and one
    window does without the counting before it. Values outside are selected as
    exactly, only the bound no longer holds. Types without a code (text,
    decimals of more than 18 digits) are selected in one window a group too.
    """
    keys = list(keys)
    kind = values.schema[value].dataType
    bits = None if domain_bits is not None and domain_bits <= WINDOW_BITS else code_bits(kind)
    rows = values.select(*keys, F.col(value).alias("__q"), F.col(weight).cast("bigint").alias("__w"))
    empty = rows.groupBy(*keys).agg(F.max(F.col("__q").isNotNull()).alias("__some")).filter(~F.col("__some")).select(
        *keys, F.lit(None).cast(kind).alias("__v"), F.lit(0).cast("bigint").alias("__nn"))
    left = rows.filter(F.col("__q").isNotNull())
    if bits is not None and bits > RADIX_BITS:
        left = left.withColumn("__code", order_code(F.col("__q"), kind))
    place = None
    for shift in range((bits or 0) - RADIX_BITS, 0, -RADIX_BITS):
        digit = F.shiftright("__code", shift)
        if place is not None:
            digit = digit.bitwiseAND(F.lit((1 << RADIX_BITS) - 1))
        left = left.withColumn("__digit", digit)
        sums = [F.sum("__w").alias("__w")] + ([F.first(c).alias(c) for c in place] if place else [])
        counted = left.groupBy(*keys, "__digit").agg(*sums)
        chosen = _pick(counted, keys, "__digit", nth, bool(place))
        named = [*keys, "__digit"]
        right = chosen.select(*[F.col(n).alias(f"__same{i}") for i, n in enumerate(named)],
                              (F.col("__place") - F.col("__run") + F.col("__w")).alias("__place"), "__nn")
        left = left.drop("__place", "__nn")
        left = left.join(right, _same(left, right, named)).drop(*[f"__same{i}" for i, _ in enumerate(named)], "__digit")
        place = ["__place", "__nn"]
    found = _pick(left, keys, "__q", nth, bool(place)).select(*keys, F.col("__q").alias("__v"), "__nn")
    return found.unionByName(empty)


def _pick(rows: DataFrame, keys: Sequence[str], order: str, nth: Column, placed: bool) -> DataFrame:
    """The row of each group in which the running weight reaches the group's place."""
    group = Window.partitionBy(*keys)
    run = F.sum("__w").over(group.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if placed:
        rows = rows.withColumn("__run", run)
    else:
        rows = rows.withColumns({"__run": run, "__nn": F.sum("__w").over(group)}).withColumn("__place", nth)
    return rows.filter((F.col("__run") >= F.col("__place")) & (F.col("__run") - F.col("__w") < F.col("__place")))


def disc_place(num: Column | int, den: Column | int) -> Column:
    """The place of PERCENTILE_DISC(num / den) among ``__nn`` values: the first whose share reaches it."""
    num, den = (F.lit(x) if isinstance(x, int) else x for x in (num, den))
    wide = "decimal(38,0)"
    # ceil(nn * num / den) in whole numbers: the product can pass 64 bits
    up = F.col("__nn").cast("decimal(19,0)") * num.cast("decimal(18,0)") + den.cast("decimal(18,0)") - 1
    return F.greatest(F.lit(1).cast("bigint"), F.call_function("div", up.cast(wide), den.cast(wide)).cast("bigint"))
