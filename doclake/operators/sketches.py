"""Column statistics from mergeable sketches, and ranges of equal size placed by them.

Every file (or other part) has one row per column: exact counts, a Theta sketch of the distinct values and a KLL sketch of
the order. Rows of parts merge into those of a table, so new files are read once and old ones never again, and the
statistics of a table of any size are merged from a few kilobytes a file. From the merged sketch come equi-depth
histograms, and the bounds of the ranges of an index: rows are put in order without the sampling pass that range
partitioning makes over its input.

The order of a column is that of a long: whole numbers, dates, timestamps (microseconds) and booleans as they are, other
numbers by their double, texts and binaries by their first seven bytes (texts that agree in these are in order within a
range only). Columns of other types have no order: no edges, and no ranges.

Defined cases: nulls are counted but are in no sketch, and stand in the first range; a column without values has an empty
histogram; NaN is above all numbers; an empty table gives no rows.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

KLL_K = 800  # rank error of about 0.4 %
HOT = 0.25  # of a range: a value with more rows is divided among the ranges it reaches into
THETA_LG = 14  # error of about 0.8 % (one deviation)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def order_key(name: str, kind: T.DataType) -> Column | None:
    """A long or double in the order of the column (texts: of their first seven bytes)."""
    c = F.col(f"`{name}`")
    if isinstance(kind, _WHOLE):
        return c.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, (T.DecimalType, T.FractionalType)):
        return c.cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")
    return None


def _family(kind: T.DataType) -> str:
    return "double" if isinstance(kind, (T.DecimalType, T.FractionalType)) else "bigint"


def part_sketches(rows: DataFrame, cols: list[str], part: str) -> DataFrame:
    """Per part and column: ``part, column, n_rows, n_values, distinct, longs, doubles`` (the latter three are sketches).

    ``part`` is the SQL expression that names the part of a row, such as ``_metadata.file_path``. Counting and sketching happen before the shuffle, so
    what moves is one row per task and part.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    aggs, lines = [F.count(F.lit(1)).alias("n")], []
    for i, name in enumerate(cols):
        key = order_key(name, kinds[name])
        whole = F.xxhash64(F.col(f"`{name}`"))
        value = F.when(F.col(f"`{name}`").isNotNull(), whole)
        aggs += [F.count(value).alias(f"v{i}"), F.theta_sketch_agg(value, F.lit(THETA_LG)).alias(f"t{i}")]
        sketch = {"bigint": F.lit(None).cast("binary"), "double": F.lit(None).cast("binary")}
        if key is not None:
            family = _family(kinds[name])
            aggs.append(getattr(F, f"kll_sketch_agg_{family}")(key, F.lit(KLL_K)).alias(f"q{i}"))
            held = getattr(F, f"kll_sketch_get_n_{family}")(f"q{i}")  # NaN is in no sketch
            sketch[family] = F.when(held > 0, F.col(f"q{i}"))
        lines.append(
            F.struct(
                F.lit(i).alias("position"), F.lit(name).alias("column"), F.col("n").alias("n_rows"), F.col(f"v{i}").alias("n_values"),
                F.col(f"t{i}").alias("distinct"), sketch["bigint"].alias("longs"), sketch["double"].alias("doubles"),
            )
        )
    return rows.groupBy(F.expr(part).alias("part")).agg(*aggs).select("part", F.inline(F.array(*lines)))


def merged(sketches: DataFrame) -> DataFrame:
    """The sketches of all parts in one row per column, without ``part``."""
    return sketches.groupBy("position", "column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.theta_union_agg("distinct", F.lit(THETA_LG)).alias("distinct"),
        F.kll_merge_agg_bigint("longs", F.lit(KLL_K)).alias("longs"), F.kll_merge_agg_double("doubles", F.lit(KLL_K)).alias("doubles"),
        F.count("longs").alias("n_longs"), F.count("doubles").alias("n_doubles"),
    )


def _quantiles(ranks: list[float]) -> tuple[Column, Column]:
    """Of whole and of other numbers; one of them, or both, are null."""
    points = F.array(*map(F.lit, ranks))
    longs = F.when(F.col("n_longs") > 0, F.kll_sketch_get_quantile_bigint("longs", points))
    doubles = F.when(F.col("n_doubles") > 0, F.kll_sketch_get_quantile_double("doubles", points))
    return longs, doubles


def histograms(sketches: DataFrame, buckets: int = 16) -> DataFrame:
    """``column, n_rows, n_values, n_distinct, edges`` from the sketches of any parts. Between two of the ``buckets + 1``
    edges (order keys, as doubles) lie about as many values as between any other two."""
    longs, doubles = _quantiles([i / buckets for i in range(buckets + 1)])
    return merged(sketches).select(
        "column", "n_rows", "n_values", F.theta_sketch_estimate("distinct").alias("n_distinct"),
        F.coalesce(longs.cast("array<double>"), doubles, F.array().cast("array<double>")).alias("edges"),
    )


class Bounds(NamedTuple):
    """The inner bounds of ranges, and of every hot value among them the ranks below and up to it."""

    values: list[int | float]
    hot: dict[int | float, tuple[float, float]]


def range_bounds(sketches: DataFrame, column: str, ranges: int) -> Bounds:
    """The ``ranges - 1`` inner bounds of ranges of equal size: a few numbers per range are all that reaches the driver."""
    one = merged(sketches.filter(F.col("column") == column)).select("longs", "doubles", "n_longs", "n_doubles")
    ranks = [i / ranges for i in range(1, ranges)]
    found = one.select(*_quantiles(ranks)).first() if ranks else None
    if found is None or not (found[0] or found[1]):
        return Bounds([], {})
    whole, values = bool(found[0]), found[0] or found[1]
    distinct = sorted(set(values))
    rank, sketch = (F.kll_sketch_get_rank_bigint, "longs") if whole else (F.kll_sketch_get_rank_double, "doubles")
    before = [v - 1 if whole else math.nextafter(v, -math.inf) for v in distinct]
    low, high = one.select(*(rank(sketch, F.array(*map(F.lit, at))) for at in (before, distinct))).first()
    return Bounds(values, {v: (a, b) for v, a, b in zip(distinct, low, high) if b - a > HOT / ranges})


def _bounds_below(key: Column, bounds: list[int | float], or_equal: bool) -> Column:
    """How many bounds are below the key: first over every ``step``-th bound, then within that step."""
    step = max(1, int(len(bounds) ** 0.5))

    def counted(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: (b <= key) if or_equal else (b < key)))

    last = F.array(*(F.lit(b) for b in bounds[step - 1 :: step]))
    steps = counted(last)
    return steps * step + counted(F.slice(F.array(*(F.lit(b) for b in bounds)), steps * step + 1, F.lit(step)))


def range_of(key: Column, tie: Column, bounds: Bounds) -> Column:
    """The range of a key. The rows of a hot value are dealt out by ``tie`` evenly over its ranks, so over all ranges that it
    reaches into, and it is no hot task. Nulls are in range 0."""
    if not bounds.values:
        return F.lit(0)
    out = _bounds_below(key, bounds.values, False)
    if bounds.hot:
        kind = "bigint" if isinstance(bounds.values[0], int) else "double"
        pairs = [(F.lit(value).cast(kind), F.array(*map(F.lit, ranks))) for value, ranks in bounds.hot.items()]
        spans = F.create_map(*(c for pair in pairs for c in pair))
        span = F.try_element_at(spans, key)
        share = F.pmod(F.xxhash64(tie), F.lit(1 << 30)) / (1 << 30)
        rank = F.try_element_at(span, F.lit(1)) * (1 - share) + F.try_element_at(span, F.lit(2)) * share
        dealt = F.floor(rank * (len(bounds.values) + 1)).cast("int")
        within = F.least(F.greatest(dealt, out), _bounds_below(key, bounds.values, True))
        out = F.when(span.isNotNull(), within).otherwise(out)
    return F.coalesce(F.when(key.isNotNull(), out), F.lit(0))


def ranged(rows: DataFrame, column: str, tie: str, sketches: DataFrame, ranges: int) -> DataFrame:
    """The rows in ``ranges`` partitions in the order of ``column`` (then ``tie`` within a partition), with ``_range``.

    The bounds come from sketches taken when the rows were written, so the rows are read once and shuffled once.
    """
    kind = rows.schema[column].dataType
    key = order_key(column, kind)
    if key is None:
        raise ValueError(f"no order for {column}: {kind.simpleString()}")
    placed = rows.withColumn("_range", range_of(key, F.col(f"`{tie}`"), range_bounds(sketches, column, ranges)))
    return placed.repartitionById(ranges, F.col("_range")).sortWithinPartitions(F.col(f"`{column}`"), F.col(f"`{tie}`"))
