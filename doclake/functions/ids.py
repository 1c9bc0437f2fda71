"""Identifier, path and formatting expressions (all built-in, no Python at run time)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def oid_seconds(oid: Column) -> Column:
    """Creation second held in the first eight hex digits of a 24-digit object id."""
    return F.conv(F.substring(oid, 1, 8), 16, 10).cast("bigint")


def oid_floor(seconds: Column) -> Column:
    """Smallest object id of a given second: the hex prefix padded with zeros."""
    return F.rpad(F.lpad(F.lower(F.hex(seconds)), 8, "0"), 24, "0")


def hex_uuid(raw: Column) -> Column:
    """Sixteen bytes as lower-case 8-4-4-4-12 text."""
    h = F.lower(F.hex(raw))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(h, at, n) for at, n in cuts])


def path_key(path: Column) -> Column:
    """Lookup key of a guide path: no ``$.`` prefix, no quotes; the root path has none."""
    return F.when(path != "$", F.replace(F.substr(path, F.lit(3)), F.lit('"'), F.lit("")))


def path_prefixes(key: Column) -> Column:
    """``a.b.c`` -> ``[{a, b.c}, {a.b, c}, {a.b.c, ''}]`` as ``array<struct<prefix,suffix>>``."""
    parts = F.split(key, r"\.")
    n = F.size(parts)
    return F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.struct(
            F.concat_ws(".", F.slice(parts, F.lit(1), i)).alias("prefix"),
            F.when(i < n, F.concat_ws(".", F.slice(parts, i + 1, n - i)))
            .otherwise(F.lit("")).alias("suffix"),
        ),
    )


def clean_index_name(name: Column) -> Column:
    return F.replace(name, F.lit("."), F.lit("_"))


def index_table_name(collection: Column, index_name: Column) -> Column:
    return F.concat_ws("$", collection, clean_index_name(index_name))


def human_size(n_bytes: Column) -> Column:
    """Binary units, one decimal, next unit only strictly above 1024 of the previous one."""
    mb = n_bytes / F.lit(float(1 << 20))
    gb = n_bytes / F.lit(float(1 << 30))
    tb = n_bytes / F.lit(float(1 << 40))
    return (
        F.when(gb > 1024, F.format_string("%.1f TB", tb))
        .when(mb > 1024, F.format_string("%.1f GB", gb))
        .otherwise(F.format_string("%.1f MB", mb))
    )


def human_duration(millis: Column) -> Column:
    """``0.042s`` below one second, else ``1h 2m 3s`` with zero parts left out."""
    total = F.floor(millis / 1000).cast("bigint")
    h = F.floor(total / 3600).cast("bigint")
    m = F.floor(F.pmod(total, F.lit(3600)) / 60).cast("bigint")
    s = F.pmod(total, F.lit(60))
    long_form = F.concat_ws(
        " ",
        F.when(h > 0, F.format_string("%dh", h)),
        F.when(m > 0, F.format_string("%dm", m)),
        F.when(s > 0, F.format_string("%ds", s)),
    )
    return F.when(millis < 1000, F.format_string("0.%03ds", millis.cast("bigint"))).otherwise(long_form)


def percent_of(part: Column, whole: Column) -> Column:
    """Percent with one decimal; null where there is nothing to compare with."""
    return F.when(whole > 0, F.round(F.lit(100.0) * part / whole, 1))
