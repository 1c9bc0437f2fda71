"""Indexes as ordinary Spark tables: path projections, array views, postings, grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from doclake.functions.variants import elements, field, typed, variant_path
from doclake.operators.guide import flatten
from doclake.runtime import stored

Key = tuple[str, str]


def array_chain(keys: list[str], arrays: set[str]) -> list[str]:
    """Distinct array paths the keys run through, outermost first; refuses parallel branches."""
    found = set()
    for path in keys:
        parts = path.split(".")
        found |= {".".join(parts[:n]) for n in range(1, len(parts) + 1)} & arrays
    chain = sorted(found, key=lambda p: p.count("."))
    for outer, inner in zip(chain, chain[1:]):
        if not inner.startswith(outer + "."):
            raise ValueError(f"parallel arrays: {outer} and {inner}")
    return chain


def unnest(df: DataFrame, keys: list[Key], arrays: set[str], strict: bool = True,
           spark_types: dict[str, str] | None = None, outer: bool = True, keep=("id",)) -> DataFrame:
    """One typed column per key, one row per element along the array chain.

    Each array is exploded once and the whole document is dropped as soon as
    the key values outside the arrays are out, so elements do not carry it along.
    """
    spark_types = spark_types or {}
    chain = array_chain([k for k, _ in keys], arrays)
    placed: dict[str, list[Key]] = {a: [] for a in ["", *chain]}
    for path, gtype in keys:
        holders = [a for a in chain if path == a or path.startswith(a + ".")]
        placed[holders[-1] if holders else ""].append((path, gtype))
    names = {path: f"_k{i}" for i, (path, _) in enumerate(keys)}

    def sub_values(value: Column, base: str) -> list[Column]:
        return [field(value, path[len(base):].lstrip(".")).alias(names[path]) for path, _ in placed[base]]

    frame, value, base, held = df, F.col("data"), "", []
    for array_path in chain:
        inner = array_path[len(base):].lstrip(".")
        frame = frame.select(*keep, *held, *sub_values(value, base), field(value, inner).alias("_a"))
        held += [names[p] for p, _ in placed[base]]
        # Always the outer form: the inner one would make Spark test the array, and so parse, twice.
        frame = frame.select(*keep, *held, F.explode_outer(elements(F.col("_a"))).alias("_e"))
        if not outer:
            frame = frame.filter(F.col("_e").isNotNull())
        value, base = F.col("_e"), array_path
    # Sub-value, its schema and the typed value are separate steps, so that each is worked out once.
    frame = frame.select(*keep, *held, *sub_values(value, base))
    schemas = {path: F.schema_of_variant(names[path]).alias(names[path] + "s") for path, _ in keys}
    frame = frame.select(*keep, *names.values(), *schemas.values())
    return frame.select(
        *keep,
        *[
            typed(F.col(names[path]), F.col(names[path] + "s"), path, gtype, strict, spark_types.get(path)).alias(path)
            for path, gtype in keys
        ],
    )


def array_view(df: DataFrame, keys: list[Key], arrays: set[str], strict: bool = True,
               spark_types: dict[str, str] | None = None) -> DataFrame:
    """``id`` and one column per key path; a missing, null or empty array keeps one row of nulls."""
    return unnest(df, keys, arrays, strict, spark_types)


def refresh_array_view(view: DataFrame, changed: DataFrame, deleted_ids: DataFrame, keys: list[Key],
                       arrays: set[str], spark_types: dict[str, str] | None = None) -> DataFrame:
    """View after a change set: rows of changed and deleted documents replaced, the rest kept.

    Spark picks a broadcast only when the change set is measured to be small.
    """
    touched = changed.select("id").unionByName(deleted_ids.select("id"))
    kept = view.join(touched, "id", "left_anti")
    return kept.unionByName(array_view(changed, keys, arrays, True, spark_types))


def _order(name: str, asc: bool) -> Column:
    c = F.col(f"`{name}`")
    return c.asc_nulls_last() if asc else c.desc_nulls_first()


def index_table(
    rows: DataFrame, order: list[tuple[str, bool]], partitions: int | None = None, stage: bool = True
) -> DataFrame:
    """Rows range-partitioned and sorted in index order, row id last.

    The id takes part in the ranges, so one hot key value spreads over several
    partitions. Finding the ranges reads all rows once more; with ``stage`` the
    narrow index rows are written first, so that documents are parsed only once.
    """
    if stage:
        rows = stored(rows, "index-rows")
    by = [_order(name, asc) for name, asc in order] + [F.col("id").asc_nulls_last()]
    placed = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    return placed.sortWithinPartitions(*by)


def path_index(df: DataFrame, keys: list[Key], strict: bool = True,
               spark_types: dict[str, str] | None = None) -> DataFrame:
    """One row per document with its key columns; documents without any key are indexed too."""
    return unnest(df, keys, set(), strict, spark_types)


def multivalue_index(df: DataFrame, path: str, gtype: str, arrays: set[str],
                     spark_type: str | None = None) -> DataFrame:
    """Distinct ``(value, id)`` per array element; nothing for empty arrays."""
    types = {path: spark_type} if spark_type else None
    rows = unnest(df, [(path, gtype)], arrays, True, types, outer=False)
    return rows.withColumnRenamed(path, "value").dropDuplicates(["value", "id"])


def unique_violations(rows: DataFrame, cols: list[str], fail: bool = False) -> DataFrame:
    """Key combinations held by more than one row; nulls compare equal."""
    bad = rows.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if fail:
        first = bad.first()
        if first is not None:
            raise ValueError(f"unique index violated by {first.asDict()}")
    return bad


def primary_key(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows, null keys, and keys held more than once."""
    per_key = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("n_null"),
        F.count_if(F.col("k").isNotNull() & (F.col("n") > 1)).alias("n_duplicate_keys"),
    )


def token_rows(strings: DataFrame, text: str = "value") -> DataFrame:
    """One row per lower-case run of ASCII letters and digits.

    Empty pieces are dropped after the outer explode: an inner one, or a filter
    on the array, would have Spark split every text twice.
    """
    pieces = F.split(F.lower(F.col(text)), "[^a-z0-9]+")
    return strings.select("id", F.explode_outer(pieces).alias("token")).filter("token <> ''")


def text_postings(strings: DataFrame, text: str = "value") -> DataFrame:
    """``(token, id, tf)`` from rows of text.

    The only shuffle moves distinct (token, id) pairs, spread by both, so a
    frequent token is never one group.
    """
    return token_rows(strings, text).groupBy("token", "id").agg(F.count(F.lit(1)).alias("tf"))


def text_index(df: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Postings over every string of every document."""
    return text_postings(flatten(df, max_depth).filter("type = 'string'"))


def document_frequency(postings: DataFrame) -> DataFrame:
    return postings.groupBy("token").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("tf").alias("n_hits"))


POINT = "struct<lon:double,lat:double>"


def geo_point(v: Column, dotted: str, strict: bool = True) -> Column:
    """``struct<lon,lat>`` of a GeoJSON point value; missing gives null, another shape raises or gives null."""
    point = F.struct(
        F.try_variant_get(v, "$.coordinates[0]", "double").alias("lon"),
        F.try_variant_get(v, "$.coordinates[1]", "double").alias("lat"),
    )
    good = (
        (F.try_variant_get(v, "$.type", "string") == "Point")
        & point["lon"].between(-180, 180) & point["lat"].between(-90, 90)
    )
    none = F.lit(None).cast(POINT)
    wrong = F.raise_error(F.lit(f"value at '{dotted}' is not a GeoJSON point")).cast(POINT) if strict else none
    return F.when(v.isNull() | F.is_variant_null(v), none).when(F.coalesce(good, F.lit(False)), point).otherwise(wrong)


def spatial_index(df: DataFrame, dotted: str, cell_deg: float = 1.0, strict: bool = True) -> DataFrame:
    """``(cell_x, cell_y, lon, lat, id)`` for documents that have a point."""
    values = df.select("id", field(F.col("data"), dotted).alias("v"))
    # Through a generator, which a filter is not pushed below: the document is parsed once, not once per test.
    point = F.array(geo_point(F.col("v"), dotted, strict))
    located = values.select("id", F.inline_outer(point)).filter("lon is not null")
    return located.select(
        F.floor(F.col("lon") / cell_deg).cast("int").alias("cell_x"),
        F.floor(F.col("lat") / cell_deg).cast("int").alias("cell_y"),
        "lon", "lat", "id",
    )


def in_box(index: DataFrame, west: float, south: float, east: float, north: float, cell_deg: float = 1.0) -> DataFrame:
    """Points in a box; the cell range prunes files first, the exact test follows."""
    return index.filter(
        F.col("cell_x").between(int(west // cell_deg), int(east // cell_deg))
        & F.col("cell_y").between(int(south // cell_deg), int(north // cell_deg))
        & F.col("lon").between(west, east) & F.col("lat").between(south, north)
    )


def points_only(df: DataFrame, dotted: str, n: int = 100) -> DataFrame:
    """Whether ``n`` documents with a point exist; the scan stops once they are found."""
    kind = F.try_variant_get(F.col("data"), variant_path(dotted + ".type"), "string")
    return df.filter(kind == "Point").limit(n).agg((F.count(F.lit(1)) == n).alias("points_only"))


def only_points(df: DataFrame, dotted: str) -> bool:
    """Whether no document has another geometry than a point; the scan stops at the first that has."""
    kind = F.try_variant_get(F.col("data"), variant_path(dotted + ".type"), "string")
    return df.filter(kind != "Point").isEmpty()


def index_stats(rows: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """Rows, non-nulls, distinct values, low and high of each column, as one row per column.

    Exact distinct counts shuffle the values of every column; ``exact=False``
    estimates them with mergeable sketches and shuffles one row per task.
    """
    quoted = {c: F.col(f"`{c}`") for c in cols}
    distinct = F.count_distinct if exact else F.approx_count_distinct
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(quoted.values()):
        aggs += [
            F.count(c).alias(f"v{i}"), distinct(c).alias(f"d{i}"),
            F.min(c).cast("string").alias(f"l{i}"), F.max(c).cast("string").alias(f"h{i}"),
        ]
    one = rows.agg(*aggs)
    lines = [
        F.struct(
            F.lit(name).alias("column"), F.col("n").alias("n_rows"), F.col(f"v{i}").alias("n_values"),
            F.col(f"d{i}").alias("n_distinct"), F.col(f"l{i}").alias("low"), F.col(f"h{i}").alias("high"),
        )
        for i, name in enumerate(cols)
    ]
    return one.select(F.inline(F.array(*lines)))
