"""Document shaping: parsing, keys, system columns, path extraction, JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from doclake.functions.variants import field, only

ALLOW_DUPLICATES = "spark.sql.variant.allowDuplicateKeys"


def parse_docs(df: DataFrame, doc: str = "doc", data: str = "data") -> DataFrame:
    """Parse JSON text once into VARIANT; malformed text gives null (see ``invalid_docs``)."""
    return df.withColumn(data, F.try_parse_json(F.col(doc)))


def duplicate_key_policy(spark, allow: bool) -> None:
    """Repeated keys in an object: rejected as malformed (default) or last one wins.

    A session setting that Spark reads when the query is planned and run, so
    set it before the action.
    """
    spark.conf.set(ALLOW_DUPLICATES, "true" if allow else "false")


def invalid_docs(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Rows whose text is not one valid JSON value."""
    return df.filter(F.col(doc).isNull() | F.try_parse_json(F.col(doc)).isNull())


def assign_id(df: DataFrame, method: str = "embedded", data: str = "data") -> DataFrame:
    """Row key: the value at ``_id`` or a generated UUID.

    A generated key is random per evaluation: write the result before using it
    twice.
    """
    if method == "embedded":
        return df.withColumn("id", F.try_variant_get(F.col(data), "$._id", "string"))
    if method == "uuid":
        return df.withColumn("id", F.uuid())
    raise ValueError(f"unknown key method {method!r}: embedded or uuid")


def with_keys(df: DataFrame, methods: dict[str, str], collection: str = "collection") -> DataFrame:
    """``id`` by each collection's method: ``UUID`` gives a generated key, else the decoded one stays, generated if missing.

    Write the result before using it twice.
    """
    generated = [name for name, method in methods.items() if method == "UUID"]
    own = F.coalesce("id", F.uuid())
    return df.withColumn("id", F.when(F.col(collection).isin(generated), F.uuid()).otherwise(own) if generated else own)


def with_system_columns(df: DataFrame) -> DataFrame:
    now = F.current_timestamp()
    return df.withColumns({"version": F.lit("1"), "last_modified": now, "created_on": now})


def materialise_id(df: DataFrame, data: str = "data") -> DataFrame:
    """Rebuild ``id`` from the document; a missing or array ``_id`` stops the job."""
    v = field(F.col(data), "_id")
    kind = F.schema_of_variant(v)
    text = F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))
    checked = (
        F.when(v.isNull() | (kind == "VOID"), F.raise_error(F.lit("document without _id")).cast("string"))
        .when(kind.startswith("ARRAY"), F.raise_error(F.lit("_id is an array")).cast("string"))
        .otherwise(text)
    )
    return df.withColumn("id", checked)


def to_json_text(df: DataFrame, source: str = "data", out: str = "doc") -> DataFrame:
    """Document column (VARIANT or struct) as JSON text; null fields are kept."""
    return df.withColumn(out, F.to_json(F.col(source), {"ignoreNullFields": "false"}))


def extract(df: DataFrame, fields: dict[str, tuple[str, str]], strict: bool = False, keep=("id",)) -> DataFrame:
    """Typed columns from paths: ``{name: (dotted path, guide type)}``."""
    cols = [only(F.col("data"), path, gtype, strict).alias(name) for name, (path, gtype) in fields.items()]
    return df.select(*keep, *cols)


def wrap(df: DataFrame, array_col: str, name: str = "dg", out: str = "wrapped") -> DataFrame:
    """Put an array column into a JSON object ``{name: [...]}``."""
    return df.withColumn(
        out, F.to_json(F.struct(F.col(array_col).alias(name)), {"ignoreNullFields": "false"})
    )


def unwrap(df: DataFrame, schema: str, keep: list[str], name: str = "dg", wrapped: str = "wrapped") -> DataFrame:
    """Expand the nested array of such an object into typed rows; an empty one keeps a null row."""
    parsed = F.from_json(wrapped, f"{name} array<struct<{schema}>>")[name]
    return df.select(*keep, F.inline_outer(parsed))


def range_scan(df: DataFrame, key: str | Column, lo, hi) -> DataFrame:
    """``lo <= key < hi`` as a plain filter, so Parquet statistics can skip row groups."""
    k = F.col(key) if isinstance(key, str) else key
    return df.filter((k >= lo) & (k < hi))


