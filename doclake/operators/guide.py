"""Schema inference: flatten documents, aggregate them into a data guide, use the guide."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from doclake.functions.ids import path_key, path_prefixes
from doclake.operators.geometry import is_geometry

CONTAINERS = ("object", "array")
GROUPS = 1 << 16  # of a task, with a bitmap of 4 KiB each at most


def document_depth(df: DataFrame, data: str = "data") -> int:
    """Deepest nesting over all documents (a flat object has depth 1)."""
    return deepest(df, data).first()[0]


def deepest(df: DataFrame, data: str = "data") -> DataFrame:
    """One row with the deepest nesting, ``depth``.

    A document is reduced to its brackets; removing innermost pairs until
    nothing is left counts the levels. Documents deeper than all steps can
    peel stop the job instead of being measured too shallow.
    """
    no_text = F.regexp_replace(F.to_json(F.col(data)), r'"(?:[^"\\]++|\\.)*+"', "")
    brackets = F.translate(F.regexp_replace(no_text, r"[^\[\]{}]++", ""), "[]", "{}")

    def peel(acc, _):
        left = acc["s"] != ""
        return F.struct(
            F.replace(acc["s"], F.lit("{}"), F.lit("")).alias("s"),
            F.when(left, acc["n"] + 1).otherwise(acc["n"]).alias("n"),
        )

    def levels(most: int, start: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, peel)

    few = df.select(levels(8, F.struct(brackets.alias("s"), F.lit(0).alias("n"))).alias("few"))
    all_ = few.select(F.when(F.col("few.s") == "", F.col("few")).otherwise(levels(1000, F.col("few"))).alias("all"))
    too_deep = F.raise_error(F.lit("a document is nested deeper than 1008 levels")).cast("int")
    depth = F.when(F.col("all.s") != "", too_deep).otherwise(F.col("all.n"))
    return all_.agg(F.coalesce(F.max(depth), F.lit(0)).alias("depth"))


def _step(parent: Column, key: Column) -> Column:
    """Child path; a name holding a dot or a space is quoted (two searches, far cheaper than a pattern)."""
    odd = key.contains(".") | key.contains(" ")
    return F.concat(parent, F.lit("."), F.when(odd, F.concat(F.lit('"'), key, F.lit('"'))).otherwise(key))


def _scalar_text(v: Column, kind: Column) -> Column:
    """Text of a scalar; whole numbers are read as such, as casting in the variant builds an expression per value."""
    text = F.try_variant_get(v, "$", "string")
    return F.when(kind == "BIGINT", F.try_variant_get(v, "$", "bigint").cast("string")).otherwise(text)


def walk(
    df: DataFrame, max_depth: int, keep: tuple[str, ...] = ("id",), data: str = "data", geojson: bool = False
) -> DataFrame:
    """Every node of every document in one pass over the input.

    Level by level the containers are exploded laterally, so the input is
    scanned and parsed once whatever the depth. A container is two rows: its
    own node, and one that holds the value and turns into its children; so rows
    stay flat and are linear in the document. Documents nested deeper than
    ``max_depth`` stop the job instead of being cut. With ``geojson`` an object
    that is a geometry is a node of that type, and nothing below it is looked at.
    """
    node = {"key": "string", "pos": "int", "type": "string", "integral": "boolean", "value": "string"}
    carried = [*keep, "_doc"]
    frame = df.select(
        *keep,
        F.monotonically_increasing_id().alias("_doc"),
        F.lit("$").alias("_path"),
        F.lit(False).alias("_in"),
        *[F.lit(None).cast(kind).alias(f"_{name}") for name, kind in node.items()],
        F.col(data).alias("_v"),
    )
    for level in range(max_depth):
        out = frame.lateralJoin(
            df.sparkSession.tvf.variant_explode_outer(F.col("_v").outer())
        )
        # What holds no value is a finished node and passes; a value without children is gone
        out = out.filter(F.col("_v").isNull() | F.col("pos").isNotNull()).select(
            *carried, *[f"_{name}" for name in node], "pos", "key", "value",
            F.when(F.col("key").isNull(), F.col("_path")).otherwise(_step(F.col("_path"), F.col("key"))).alias("_path"),
            (F.col("_in") | (F.col("pos").isNotNull() & F.col("key").isNull())).alias("_in"),
            # A step of its own, so that it is worked out once
            F.schema_of_variant("value").alias("_kind"),
        )
        kind = F.col("_kind")
        if geojson:
            shape = F.when(kind.startswith("OBJECT<") & is_geometry(F.col("value")), "GEOJSON").otherwise(kind)
            out = out.withColumn("_kind", shape)
        is_object, is_array = kind.startswith("OBJECT<"), kind.startswith("ARRAY<")
        scalar = ~(is_object | is_array | (kind == "GEOJSON"))
        is_elem = F.col("pos").isNotNull() & F.col("key").isNull()
        made = {
            "key": F.col("key"),
            "pos": F.when(is_elem, F.col("pos")),
            "type": F.when(kind == "STRING", "string")
            .when((kind == "BIGINT") | kind.startswith("DECIMAL"), "number")
            .when(is_object, "object").when(is_array, "array").when(kind == "GEOJSON", "geojson")
            .when(kind == "BOOLEAN", "boolean")
            .when((kind == "DOUBLE") | (kind == "FLOAT"), "double")
            .when(kind.startswith("TIMESTAMP") | (kind == "DATE"), "timestamp")
            .when(kind == "BINARY", "binary"),
            "integral": kind == "BIGINT",
            "value": F.when(scalar, _scalar_text(F.col("value"), kind)),
        }
        frame = out.select(
            *carried, "_kind", "_in",
            F.when(is_elem & scalar, F.concat(F.col("_path"), F.lit("[*]"))).otherwise(F.col("_path")).alias("_path"),
            *[F.coalesce(column, F.col(f"_{name}")).alias(f"_{name}") for name, column in made.items()],
            F.when(is_object | is_array, F.col("value")).alias("_v"),
        )
        if level < max_depth - 1:
            alone, both = F.array(F.lit(False)), F.array(F.lit(False), F.lit(True))
            frame = frame.select("*", F.explode(F.when(F.col("_v").isNotNull(), both).otherwise(alone)).alias("_goes"))
            frame = frame.select(
                *carried, "_path", "_in",
                *[F.when(~F.col("_goes"), F.col(f"_{name}")).alias(f"_{name}") for name in node],
                F.when(F.col("_goes"), F.col("_v")).alias("_v"),
            )
    if not max_depth:
        return frame.filter(F.lit(False)).select(
            *carried, F.col("_path").alias("path"), *[F.col(f"_{name}").alias(name) for name in node], F.col("_in").alias("in_array")
        )
    # A non-empty container left over after the last level means the depth was too small.
    deeper = F.col("_v").isNotNull() & ~F.col("_kind").isin("OBJECT<>", "ARRAY<VOID>")
    stop = F.raise_error(F.lit(f"document nested deeper than max_depth={max_depth}")).cast("array<string>")
    is_node = F.col("_key").isNotNull() | F.col("_pos").isNotNull()
    # Through a generator, which filters on the path are not pushed below: the schema is worked out once
    path = F.explode(F.when(deeper, stop).when(is_node, F.array("_path")).otherwise(F.array().cast("array<string>")))
    return frame.select(*carried, path.alias("path"), *[F.col(f"_{name}").alias(name) for name in node], F.col("_in").alias("in_array"))


def flatten(
    df: DataFrame, max_depth: int | None = None, keep: tuple[str, ...] = ("id",), data: str = "data", geojson: bool = False
) -> DataFrame:
    """``(keep…, path, type, value)`` rows: fields anywhere, and scalar array elements as ``path[*]``.

    Without ``max_depth`` the depth is measured first by one extra pass.
    """
    depth = document_depth(df, data) if max_depth is None else max_depth
    nodes = walk(df, depth, keep, data, geojson)
    return nodes.filter(F.col("key").isNotNull() | F.col("path").endswith("[*]"))


def flatten_leaves(df: DataFrame, keep: tuple[str, ...] = ("id",), leaves: str = "leaves") -> DataFrame:
    """Same rows from the typed ``leaves`` of decoded binary records: keeps timestamps and binaries."""
    # Numbered in a step of its own: next to the generator it would number the leaves.
    numbered = df.select(*keep, F.monotonically_increasing_id().alias("_doc"), leaves)
    rows = numbered.select(*keep, "_doc", F.inline(leaves))
    return rows.filter(F.col("key").isNotNull() | F.col("path").endswith("[*]"))


def _ordered(text: Column, gtype: Column) -> Column:
    """Something that orders values of one type: numbers as numbers, all else as text."""
    as_double = F.when(gtype.isin("number", "double"), text.try_cast("double"))
    # Doubles stop telling whole numbers apart at 2^53; only those pay for an exact comparison.
    exact = F.when(F.abs(as_double) >= float(1 << 53), text.try_cast("decimal(38,0)"))
    return F.when(text.isNotNull(), F.struct(as_double.alias("n"), exact.alias("i"), text.alias("t")))


def _scale(text: Column, gtype: Column) -> Column:
    """Digits behind the decimal point of a number's text."""
    mantissa = F.substring_index(text, "E", 1)
    behind = F.when(F.contains(mantissa, F.lit(".")), F.length(F.substring_index(mantissa, ".", -1))).otherwise(0)
    exponent = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).try_cast("int")).otherwise(0)
    return F.when(gtype == "number", F.greatest(F.lit(0), behind - F.coalesce(exponent, F.lit(0))))


@contextmanager
def hashed(spark: SparkSession):
    """Guides that are written inside keep up to ``GROUPS`` groups a task in a hash map, and sort nodes only beyond them.

    Elsewhere Spark does so for 128 groups. The setting is the session's, and is put back at the end.
    """
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, str(GROUPS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def guide_of(rows: DataFrame, by: tuple[str, ...] = (), names: bool = False) -> DataFrame:
    """Aggregate flattened rows to one row per (path, type).

    ``n_docs`` is exact without moving the rows of a document: a document
    number is unique within its partition, so documents are counted in bitmaps
    of 32768 that are complete after the map-side aggregate. Only paths below
    an array need them; any other path occurs once per document.
    With ``names`` the guide has ``key_chars``, the characters of the field names of all nodes, as well.
    """
    text, doc = F.col("value"), F.col("_doc")
    comparable = _ordered(text, F.col("type"))
    partial = rows.groupBy(
        *by, "path", "type", "in_array",
        F.when(F.col("in_array"), F.bitmap_bucket_number(doc)).alias("_bucket"),
    ).agg(
        F.max(F.octet_length(text)).alias("length"),
        F.min(comparable).alias("low"),
        F.max(comparable).alias("high"),
        F.count(F.lit(1)).alias("n_values"),
        F.bitmap_count(F.bitmap_construct_agg(F.when(F.col("in_array"), F.bitmap_bit_position(doc)))).alias("marked"),
        # A set of at most two: with it Spark aggregates objects, which hash maps can hold; extremes of texts alone are sorted
        F.array_min(F.collect_set("integral")).alias("integral"),
        F.max(F.when(~F.col("integral"), _scale(text, F.col("type")))).alias("scale"),
        *([F.sum(F.length(F.coalesce("key", F.lit("")))).alias("key_chars")] if names else []),
    )
    return partial.groupBy(*by, "path", "type").agg(
        F.max("length").cast("bigint").alias("length"),
        F.min("low")["t"].alias("low"),
        F.max("high")["t"].alias("high"),
        F.sum(F.when(F.col("in_array"), F.col("marked")).otherwise(F.col("n_values"))).alias("n_docs"),
        F.sum("n_values").alias("n_values"),
        F.min("integral").alias("integral"),
        F.max("scale").alias("scale"),
        *([F.sum("key_chars").alias("key_chars")] if names else []),
    )


def merge_parts(parts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Guide from the schema facts that dump readers hand out per block (column ``parts``)."""
    rows = parts.select(*by, F.inline("parts"))
    return rows.groupBy(*by, "path", "type").agg(
        F.max("length").alias("length"),
        F.min(_ordered(F.col("low"), F.col("type")))["t"].alias("low"),
        F.max(_ordered(F.col("high"), F.col("type")))["t"].alias("high"),
        F.sum("n_docs").alias("n_docs"),
        F.sum("n_values").alias("n_values"),
        F.min("integral").alias("integral"),
        F.max("scale").alias("scale"),
    )


def data_guide(
    df: DataFrame,
    limit: int | None = None,
    max_depth: int | None = None,
    by: tuple[str, ...] = (),
    order_by: str = "id",
    data: str = "data",
    geojson: bool = False,
) -> DataFrame:
    """Per (path, type): text length, low, high, documents, values.

    ``limit`` samples the first rows by ``order_by`` (a distributed top-n, not a
    sort). Rows with a null type stand for JSON nulls. With ``geojson`` objects
    that are geometries have the type ``geojson`` and no rows below them.
    """
    if limit is not None:
        df = df.orderBy(order_by).limit(limit)
    return guide_of(flatten(df, max_depth, by, data, geojson), by)


def cached_data_guide(df: DataFrame, folder: str, collection: str, **options) -> DataFrame:
    """Data guide kept per (collection, row count, options): read when all match, else computed and written."""
    spark = df.sparkSession
    chosen = "".join(f".{name}={options[name]}" for name in sorted(options))
    path = f"{folder}/{collection}.dataguide.{df.count()}{chosen}"
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        with hashed(spark):
            data_guide(df, **options).write.mode("ignore").parquet(path)
        return spark.read.parquet(path)


def key_volume(df: DataFrame, max_depth: int | None = None, count_positions: bool = False, data: str = "data") -> DataFrame:
    """Characters of all field names; ``count_positions`` also counts array positions as names."""
    depth = document_depth(df, data) if max_depth is None else max_depth
    nodes = walk(df, depth, (), data)
    names = F.length(F.coalesce("key", F.lit("")))
    if count_positions:
        names = names + F.when(F.col("key").isNull(), F.length(F.col("pos").cast("string"))).otherwise(0)
    return nodes.agg(F.sum(names).cast("bigint").alias("key_chars"))


def _whole_digits(text: Column) -> Column:
    """Digits before the decimal point of a number's text, never too few."""
    size = F.abs(text.try_cast("double"))
    return F.when(size >= 1, F.floor(F.log10(size)).cast("int") + 1).otherwise(1)


def _types_by_key(guide: DataFrame, by: tuple[str, ...]) -> DataFrame:
    number = F.col("type") == "number"
    family = F.when(F.col("type") == "double", "number").otherwise(F.col("type"))
    return (
        guide.filter(F.col("type").isNotNull() & (F.col("path") != "$"))
        .withColumn("key", path_key(F.col("path")))
        .groupBy(*by, "key")
        .agg(
            F.count_distinct(family).alias("families"),
            F.min(family).alias("family"),
            F.max(F.when(F.col("type") == "double", "double")).alias("has_double"),
            F.min("integral").alias("integral"),
            F.max("length").alias("length"),
            F.max("scale").alias("scale"),
            F.max(F.when(number, F.greatest(_whole_digits(F.col("low")), _whole_digits(F.col("high"))))).alias("digits"),
            F.min(F.when(number, F.col("low").try_cast("bigint").isNotNull() & F.col("high").try_cast("bigint").isNotNull())).alias("fits"),
        )
    )


def key_types(guide: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Type per normalised path; ``multitype`` when types of different families meet.

    ``number`` and ``double`` are one family. ``spark_type`` is a column type that holds every value seen as it is:
    ``bigint``, else a decimal with the digits needed on both sides of the point, else (beyond 38 digits) ``double``.
    """
    for column, default in (("integral", F.lit(False)), ("scale", F.lit(None).cast("int"))):
        if column not in guide.columns:
            guide = guide.withColumn(column, default)
    t = _types_by_key(guide, by)
    kind = (
        F.when(F.col("families") > 1, "multitype")
        .when(F.col("family") == "number", F.coalesce("has_double", F.lit("number")))
        .otherwise(F.col("family"))
    )
    # Ten fraction digits where there is room, as for numbers of which nothing is known
    scale = F.least(F.greatest(F.coalesce("scale", F.lit(0)), F.lit(10)), 38 - F.col("digits"))
    decimal = F.when(F.col("digits") + F.coalesce("scale", F.lit(0)) > 38, "double").otherwise(
        F.concat(F.lit("decimal(38,"), F.when(F.col("integral"), 0).otherwise(scale).cast("string"), F.lit(")"))
    )
    spark_type = (
        F.when((F.col("type") == "number") & F.col("integral") & F.col("fits"), "bigint")
        .when(F.col("type") == "number", F.coalesce(decimal, F.lit("decimal(38,10)")))
        .when(~F.col("type").isin("object", "array", "geojson", "multitype"), F.col("type"))
    )
    return t.select(*by, "key", kind.alias("type"), "length", "integral", "scale", "digits", "fits").select(
        *by, "key", "type", spark_type.alias("spark_type"), F.col("length").alias("max_length")
    )


def mat_paths(guide: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Keys classified ``ARRAY`` when the key or an ancestor is an array, else ``OTHER``.

    Empty when the collection has no array at all.
    """
    types = key_types(guide, by)
    arrays = types.filter(F.col("type") == "array").select(*by, F.col("key").alias("prefix"), F.lit(True).alias("hit"))
    rows = types.select(*by, "key", F.explode(path_prefixes(F.col("key"))).alias("p")).select(
        *by, "key", F.col("p.prefix").alias("prefix")
    )
    # An element key `tags[*]` descends from the array `tags`.
    rows = rows.withColumn("prefix", F.regexp_replace("prefix", r"\[\*\]$", ""))
    marked = (
        rows.join(arrays, [*by, "prefix"], "left")
        .groupBy(*by, "key")
        .agg(F.max(F.coalesce("hit", F.lit(False))).alias("in_array"))
    )
    if by:
        having = arrays.select(*by).distinct()
        marked = marked.join(having, list(by), "left_semi")
    else:
        any_array = arrays.limit(1).agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
        marked = marked.filter(any_array > 0)
    return marked.select(*by, "key", F.when(F.col("in_array"), "ARRAY").otherwise("OTHER").alias("path_type"))
