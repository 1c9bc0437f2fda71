"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of equal source, language and topic. The cells' token sums are raked: scaled to the target
share of every source, then of every language, then of every topic, and again, until all three marginals fit. The ratio
of raked to present tokens is a cell's weight; a document is drawn with probability ``min(1, scale * weight)``, the
scale being calibrated so that the expected tokens meet the budget. Drawing is by hash, so it is repeatable, needs no
state, and a lost task redraws the same.

Only cells are iterated over, in Spark; documents are read once to be counted and once to be drawn.

Tokens are the words of a text. A topic is the class of eight that most distinct words of the text hash into (ties: the
lowest; no word: ``none``). Targets are shares by name; where none are given they are the present shares to the power
``alpha``, scaled to 1. A name without a given target keeps nothing of the budget; a target without documents is left out.

Defined cases: null sources and languages are the name ``''``; documents without words weigh nothing and are drawn like
others of their cell, and cells without any token are kept whole (probability 1); repeated rows share one fate; an empty
table gives an empty result; further columns are ignored by ``mix_weights`` and passed on by ``mixed``. Contradictory
targets end after ``sweeps`` rounds, fitting the last marginal.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from doclake.llm.common import WordIds, map_arrow, whole_row
from doclake.runtime import stored

TOPICS = 8
CELLS_A_TASK = 100_000
DIMENSIONS = ("source", "lang", "topic")
Targets = dict[str, dict[str, float]]


def _described(batches: Iterator[pa.RecordBatch], text_at: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The columns of a batch, and the topic and tokens of its texts."""
    ids = WordIds()
    for batch in batches:
        topics, tokens = [], []
        for text in batch.column(text_at).to_pylist():
            words = ids.of(text or "")
            tokens.append(len(words))
            classes = np.bincount((np.unique(words) >> np.uint64(61)).astype(np.int64), minlength=TOPICS)
            topics.append(f"topic{classes.argmax()}" if len(words) else "none")
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(topics), pa.array(tokens, pa.int64())], names=names)


def described(docs: DataFrame, text_at: int) -> DataFrame:
    """``docs`` and two more columns at the end: the topic and the tokens of the text at column ``text_at``."""
    names = [*docs.columns, "topic", "tokens"]
    schema = StructType([*docs.schema.fields, StructField("topic", StringType()), StructField("tokens", LongType())])
    return map_arrow(docs, partial(_described, text_at=text_at, names=names), schema)


def _plain(seed: int) -> list[Column]:
    """``source, lang, text, draw``: names without null, and the number that decides on drawing."""
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), "text"), 11) / F.lit(float(1 << 53))
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("source", "lang")]
    return [*names, F.col("text").cast("string").alias("text"), draw.alias("draw")]


def target_table(cells: DataFrame, dimension: str, given: dict[str, float] | None, alpha: float) -> DataFrame:
    """``name, share`` of one marginal, adding up to 1 over the names that have tokens."""
    present = cells.filter("tokens > 0").groupBy(dimension).agg(F.sum("tokens").alias("tokens"))
    if given is None:
        shares = present.select(dimension, F.pow(F.col("tokens").cast("double"), F.lit(alpha)).alias("raw"))
    else:
        table = cells.sparkSession.createDataFrame(sorted(given.items()), f"{dimension} string, raw double")
        shares = present.join(table, dimension, "left").select(dimension, F.coalesce("raw", F.lit(0.0)).alias("raw"))
    total = shares.agg(F.sum("raw")).first()[0]
    return shares.select(dimension, (F.col("raw") / F.lit(total or 1.0)).alias("share"))


def rake(cells: DataFrame, targets: Targets | None = None, *, alpha: float = 0.7, sweeps: int = 40, tolerance: float = 1e-6) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``raked``: token shares that fit the target marginals."""
    targets = targets or {}
    # As many partitions as the cells need, not as documents would: a round over a few cells is one task without shuffles
    parts = 1 + cells.count() // CELLS_A_TASK

    def gathered(rows: DataFrame) -> DataFrame:
        return rows.coalesce(1) if parts == 1 else rows

    cells = gathered(cells)
    fitted = cells.withColumn("raked", F.col("tokens").cast("double"))
    for d in DIMENSIONS:  # the target of its name in each dimension stays with a cell
        wanted = target_table(cells, d, targets.get(d), alpha).withColumnRenamed("share", f"share_{d}")
        fitted = fitted.join(wanted, d, "left").fillna(0.0, [f"share_{d}"])
    fitted = stored(fitted, "mix-cells")
    for _ in range(sweeps):
        fitted, off = gathered(fitted), []
        for d in DIMENSIONS:
            now = F.sum("raked").over(Window.partitionBy(d))
            fitted = fitted.withColumn("factor", F.when(now > 0, F.col(f"share_{d}") / now).otherwise(0.0))
            scaled = {"raked": F.col("raked") * F.col("factor"), f"off_{d}": F.abs(F.col("factor") - 1)}
            fitted = fitted.withColumns(scaled).drop("factor")
            off.append(f"off_{d}")
        fitted = stored(fitted, "mix-cells")
        worst = fitted.filter("raked > 0").agg(F.max(F.greatest(*off))).first()[0]
        fitted = fitted.drop(*off)
        if worst is None or worst <= tolerance:
            break
    return fitted.drop(*(f"share_{d}" for d in DIMENSIONS))


def probabilities(fitted: DataFrame, budget: float) -> DataFrame:
    """``source, lang, topic, weight, probability`` of the cells; ``budget`` is the share of all tokens to expect."""
    weighed = fitted.withColumn("weight", F.when(F.col("tokens") > 0, F.col("raked") / F.col("tokens")))
    total = weighed.agg(F.sum("tokens")).first()[0] or 0
    aim, scale, whole = total * budget, 0.0, -1.0
    while True:  # cells that reach probability 1 stay there; the others share what is left of the budget
        at_one = F.coalesce(F.col("weight") * F.lit(scale) >= 1, F.lit(False))
        full, rest = weighed.agg(
            F.sum(F.when(at_one, F.col("tokens"))), F.sum(F.when(~at_one, F.col("raked")))
        ).first()
        if full == whole or not rest:
            break
        whole, scale = full, (aim - (full or 0)) / rest
    p = F.coalesce(F.least(F.lit(1.0), F.col("weight") * F.lit(scale)), F.lit(1.0))
    return weighed.select(*DIMENSIONS, "weight", p.alias("probability"))


def _cells(described_rows: DataFrame) -> DataFrame:
    return stored(described_rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "mix-cells")


def mix_weights(
    docs: DataFrame, targets: Targets | None = None, *, budget: float = 0.5, alpha: float = 0.7, seed: int = 1
) -> DataFrame:
    """One row per document (``doc_id, text, source, lang``): ``doc_id, source, lang, topic, tokens, weight, probability,
    sampled``."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_plain(seed))
    rows = stored(described(narrow, narrow.columns.index("text")).drop("text"), "mix-documents")
    chances = probabilities(rake(_cells(rows), targets, alpha=alpha), budget)
    return rows.join(chances, list(DIMENSIONS)).select(
        "doc_id", *DIMENSIONS, "tokens", "weight", "probability", (F.col("draw") < F.col("probability")).alias("sampled")
    )


def mixed(docs: DataFrame, targets: Targets | None = None, *, budget: float = 0.5, alpha: float = 0.7, seed: int = 1) -> DataFrame:
    """The sampled documents, with all their columns."""
    plain = docs.select(*_plain(seed))
    cells = _cells(described(plain.select("source", "lang", "text"), 2))
    chances = probabilities(rake(cells, targets, alpha=alpha), budget)
    whole = docs.select(whole_row(docs), *_plain(seed))
    drawn = described(whole, whole.columns.index("text")).drop("text", "tokens")
    return drawn.join(chances, list(DIMENSIONS)).filter("draw < probability").select("row.*")
