"""Typed access to VARIANT documents."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

KEPT_AS_TEXT = r"^(NaN|-?Infinity|-?[0-9.]{39,}|-?[0-9](\.[0-9]+)?E[+-][0-9]{2,4})$"
PLAIN_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")

# Guide type -> Spark column type used when nothing narrower is known.
SPARK_TYPES = {
    "string": "string",
    "number": "decimal(38,10)",
    "double": "double",
    "boolean": "boolean",
    "timestamp": "timestamp",
    "binary": "binary",
}


def variant_path(dotted: str) -> str:
    """``a.b c`` -> ``$.a['b c']``, the form the variant functions read."""
    if not dotted:
        return "$"
    return "$" + "".join(
        f".{part}" if PLAIN_NAME.match(part) else f"['{part}']" for part in dotted.split(".")
    )


def field(data: Column, dotted: str) -> Column:
    """Sub-value at a dotted path as VARIANT; null when any step is missing."""
    return F.try_variant_get(data, variant_path(dotted), "variant") if dotted else data


def elements(v: Column) -> Column:
    """Elements of an array value; a lone value counts as an array of one; null stays null."""
    return F.coalesce(
        F.try_variant_get(v, "$", "array<variant>"),
        F.when(v.isNotNull() & ~F.is_variant_null(v), F.array(v)),
    )


def typed(
    v: Column, schema: Column, dotted: str, gtype: str, strict: bool = True, spark_type: str | None = None
) -> Column:
    """Value of variant ``v``, whose schema text is ``schema``, if it has exactly the wanted type."""
    if gtype not in SPARK_TYPES:
        raise ValueError(f"{gtype!r} is not a type a key column can have")
    out = spark_type or SPARK_TYPES[gtype]
    if gtype in ("number", "double"):
        # What JSON has no number for is kept as text by the decoder: no finite number, or more digits than a decimal holds
        text = F.when(schema == "STRING", F.try_variant_get(v, "$", "string"))
        kept = F.coalesce(text.rlike(KEPT_AS_TEXT), F.lit(False))
        value = F.when(kept, text.try_cast(out)).otherwise(F.try_variant_get(v, "$", out))
        number = (schema == "BIGINT") | schema.startswith("DECIMAL") | schema.isin("DOUBLE", "FLOAT")
        ok = (number | kept) & value.isNotNull()  # a number the column type cannot hold is of a wrong type
    elif gtype == "timestamp":
        text = F.try_variant_get(v, "$", "string").try_cast("timestamp")
        ok = schema.startswith("TIMESTAMP") | (schema == "DATE") | ((schema == "STRING") & text.isNotNull())
        value = F.when(schema == "STRING", text).otherwise(F.try_variant_get(v, "$", "timestamp")).cast(out)
    elif gtype == "binary":
        text = F.unhex(F.try_variant_get(v, "$", "string"))
        ok = (schema == "BINARY") | ((schema == "STRING") & text.isNotNull())
        value = F.when(schema == "STRING", text).otherwise(F.try_variant_get(v, "$", "binary"))
    else:
        ok = schema == gtype.upper()
        value = F.try_variant_get(v, "$", out)
    none = F.lit(None).cast(out)
    wrong = (
        F.raise_error(F.concat(F.lit(f"value at '{dotted}' is not a {gtype}: "), schema)).cast(out) if strict else none
    )
    return F.when(ok, value).when(schema.isNull() | (schema == "VOID"), none).otherwise(wrong)


def only(
    data: Column, dotted: str, gtype: str, strict: bool = True, spark_type: str | None = None
) -> Column:
    """Value at ``dotted`` if it has exactly the wanted type.

    Missing and JSON null give null. Another type raises when ``strict`` and
    gives null otherwise. ``"5"`` is never taken for 5. JSON text carries no
    timestamp or binary, so for those declared types ISO text and hex text of
    the right form are accepted.
    """
    v = field(data, dotted)
    return typed(v, F.schema_of_variant(v), dotted, gtype, strict, spark_type)
