"""Chat formatting with cumulative-snapshot collapse, in DataFrame operations only.

A logger that saves a conversation after every turn leaves snapshots: conversations that are a prefix of longer ones.
Every turn gets the hash of the prefix that ends there. A conversation whose whole hash is a proper prefix of another
one goes (anti-join); of equal conversations the smallest id stays; the rest is rendered.

The prefix hash is the pair of running sums of two 64-bit hashes of (position, role, text): the position makes the sum
depend on the order, and a running sum can be cut anywhere. Turns are dealt out by ranges of (conversation, turn), so
one conversation may span any number of tasks, each of which continues from the sums carried in.

Defined cases: turns are ordered by (turn, role, text), nulls first; a turn logged twice (equal in all four columns) is
one turn; two different turns of one number both stay, in that order; a null conversation id is a conversation of its
own; a null role renders as ``unknown`` and a null text as the empty text, but neither equals a written one in hashes;
the template's own marks inside a text are escaped. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.runtime import stored

CHUNK_TURNS = 64  # turns rendered into one row: longer conversations are rows in a series
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _turn_hash(seed: int) -> Column:
    text, role = F.col("text"), F.col("role")
    parts = [F.lit(seed), F.col("pos"), role.isNull(), F.coalesce(role, F.lit("")), text.isNull(), F.coalesce(text, F.lit(""))]
    return F.xxhash64(*parts).cast("decimal(20,0)")


def _carried(parts: DataFrame, names: list[str]) -> DataFrame:
    """What the earlier ranges of a conversation sum up to, per (conv, range)."""
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "conv", "part", *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in names)
    )


def prefixes(turns: DataFrame) -> DataFrame:
    """Turns with their 1-based position and the hash pair of the prefix that ends there."""
    order = ["turn", "role", "text"]
    once = turns.select("conv_id", "turn", "role", "text").distinct()
    keyed = once.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(keyed.repartitionByRange(n, "conv", *order).withColumn("part", F.spark_partition_id()), "turns")
    run = Window.partitionBy("conv", "part").orderBy(*order)
    local = dealt.withColumn("here", F.row_number().over(run).cast("long"))
    counted = _carried(local.groupBy("conv", "part").agg(F.count("*").alias("here")), ["here"])
    placed = local.join(counted, ["conv", "part"]).withColumn("pos", F.col("here") + F.col("here_before"))
    hashed = placed.withColumns({"h1": _turn_hash(1), "h2": _turn_hash(2)})
    summed = hashed.withColumns({
        "s1": F.sum("h1").over(run.rowsBetween(Window.unboundedPreceding, 0)),
        "s2": F.sum("h2").over(run.rowsBetween(Window.unboundedPreceding, 0)),
    })
    totals = _carried(hashed.groupBy("conv", "part").agg(F.sum("h1").alias("h1"), F.sum("h2").alias("h2")), ["h1", "h2"])
    whole = "decimal(38,0)"
    return summed.join(totals, ["conv", "part"]).select(
        "conv", "conv_id", "pos", "role", "text",
        (F.col("s1") + F.col("h1_before")).cast(whole).alias("p1"),
        (F.col("s2") + F.col("h2_before")).cast(whole).alias("p2"),
    )


def maximal(prefixed: DataFrame) -> DataFrame:
    """One row per conversation that stays: ``conv, n_turns, n_copies``."""
    last = prefixed.groupBy("conv").agg(
        F.max(F.struct("pos", "p1", "p2")).alias("end"), F.first("conv_id").alias("conv_id")
    ).select("conv", "conv_id", "end.*")
    whole = last.groupBy("pos", "p1", "p2").agg(
        F.min(F.struct(F.col("conv_id").isNull(), "conv_id", "conv"))["conv"].alias("conv"), F.count("*").alias("n_copies")
    )
    inner = (
        prefixed.join(last.select("conv", F.col("pos").alias("n_turns")), "conv")
        .filter("pos < n_turns").select("pos", "p1", "p2").distinct()
    )
    return whole.join(inner, ["pos", "p1", "p2"], "left_anti").select("conv", F.col("pos").alias("n_turns"), "n_copies")


def rendered_turn(role: Column, text: Column) -> Column:
    safe = F.coalesce(text, F.lit(""))
    for mark in (OPEN, CLOSE):
        safe = F.replace(safe, F.lit(mark), F.lit(mark.replace("<|", "<\\|")))
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("unknown")), F.lit("\n"), safe, F.lit(CLOSE + "\n"))


def format_chats(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """``conv_id, part, n_turns, n_copies, text``: the rendered conversations that are no snapshot of a longer one.

    ``part`` counts the rows of a conversation from 0, each of at most ``chunk_turns`` turns; joined in order they are
    its whole text.
    """
    prefixed = stored(prefixes(turns), "prefixes")
    kept = prefixed.join(maximal(prefixed), "conv")
    pieces = kept.select(
        "conv", "conv_id", "n_turns", "n_copies", "pos",
        F.floor((F.col("pos") - 1) / chunk_turns).cast("int").alias("part"),
        rendered_turn(F.col("role"), F.col("text")).alias("piece"),
    )
    return pieces.groupBy("conv", "conv_id", "part", "n_turns", "n_copies").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"]), "").alias("text")
    ).drop("conv")
