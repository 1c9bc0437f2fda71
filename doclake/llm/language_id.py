"""Language identification by interpolated Kneser-Ney character models.

A text becomes symbols: its letters, lower-cased, and one space for every run of anything else. Per language, tasks
count the 4-grams of symbols and Spark adds the counts up over all learning documents; from the distinct 4-grams the
continuation counts of the lower orders follow by grouping, and from the counts the discounted probabilities and the
interpolation weights of every order. They are kept per language and order in arrays sorted by the hash of the n-gram
(or context), which are searched by bisection. A text gets the language of the lowest cross-entropy per symbol.

Size of what is broadcast: hashes have so few bits that all arrays together stay under ``model_mb`` even if every hash
value were taken; n-grams of one hash share an entry. So the bound holds whatever the corpus.

Rejection is calibrated on the learning documents: of those that got their own language, the mean ``m`` of the
cross-entropy and its spread ``s`` (of the deviation times the root of the length) are kept per language. A text is
rejected if it deviates by more than ``z`` spreads *and* has gone more than two thirds of the way from ``m`` to random
symbols (the logarithm of the alphabet), so that texts in two languages stay; so is a text without a letter.

Defined cases: null text or no letter gives ``und``, score 0, rejected; rows with a null language or identifier are not
learnt from; ties go to the language that sorts first; with nothing to learn from, every text is ``und`` with score 0,
and only those without a letter are rejected. Repeated rows are scored each. Further columns are ignored. Texts over
``PIECE`` characters are read in pieces of that length, each with the last symbols before it as context; their n-grams are
those of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from doclake.llm.common import map_arrow, mix, signed, whole_row
from doclake.runtime import stored

ORDER = 4
PIECE = 1 << 20  # symbols handled at once
FLUSH = 2_000_000  # distinct n-grams a task holds before it hands its counts on
SPACE = 32
_BITS = np.uint64(16)


@cache
def fold_table() -> np.ndarray:
    """16-bit symbol of every code point: the lower-case letter, or the space. Letters beyond the first plane share the
    private-use range; 0 is left for "before the text"."""
    table = np.full(0x110000, SPACE, np.uint16)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = ord(char.lower()[0])
            table[code] = low if low < 0x10000 else 0xE000 + low % 0x1900
    return table


class Cut(NamedTuple):
    """Pieces of texts: how many characters in front are only context, and whether the text goes on after the piece."""

    pieces: list[str]
    leads: list[int]
    goes_on: list[bool]


def _context(before: str) -> str:
    """The last characters of a text that make up ORDER symbols."""
    out = ""
    for char in reversed(before):
        if char.isalpha():
            out += char
        elif not out.endswith(" "):
            out += " "
        if len(out) == ORDER:
            break
    return out[::-1]


def blocks(texts: list[str | None]) -> Iterator[tuple[list[int], Cut]]:
    """Texts by groups of about PIECE characters, as (numbers, pieces)."""
    numbers, cut, size = [], Cut([], [], []), 0
    for i, text in enumerate(texts):
        lead = ""
        for at in range(0, len(text or ""), PIECE):
            piece = lead + text[at : at + PIECE]
            numbers.append(i)
            cut.pieces.append(piece)
            cut.leads.append(len(lead))
            cut.goes_on.append(at + PIECE < len(text))
            lead = _context(piece) if cut.goes_on[-1] else ""
            size += len(piece)
            if size >= PIECE:
                yield numbers, cut
                numbers, cut, size = [], Cut([], [], []), 0
    if numbers:
        yield numbers, cut


def grams(pieces: list[str], leads: list[int] | None = None, goes_on: list[bool] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram of order ORDER that ends at each symbol (the symbol itself in the low bits), and the piece it is of."""
    codes = np.frombuffer((" ".join(pieces) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = fold_table()[codes]
    gap = symbols == SPACE
    keep = np.ones(len(gap), bool)
    keep[0], keep[1:] = not gap[0], ~(gap[1:] & gap[:-1])
    lengths = np.array([len(p) + 1 for p in pieces])
    piece = np.repeat(np.arange(len(pieces)), lengths)[keep]
    symbols = symbols[keep].astype(np.uint64)
    if not len(symbols):
        return symbols, piece
    first = np.zeros(len(pieces), np.int64)
    sizes = np.bincount(piece, minlength=len(pieces))
    first[1:] = np.cumsum(sizes)[:-1]
    place = np.arange(len(symbols)) - first[piece]
    out = symbols.copy()
    for back in range(1, ORDER):
        earlier = np.zeros_like(symbols)
        earlier[back:] = symbols[:-back]
        earlier[place < back] = 0
        out |= earlier << np.uint64(16 * back)
    if leads is None or not (any(leads) or any(goes_on)):
        return out, piece
    offset = np.flatnonzero(keep) - (np.cumsum(lengths) - lengths)[piece]
    # A text ends with a space, a piece of it does not
    own = (offset >= np.array(leads)[piece]) & ~(np.array(goes_on)[piece] & (offset == lengths[piece] - 1))
    return out[own], piece[own]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task's documents."""
    held: dict[str, list[pd.Series]] = {}
    size = 0

    def summed() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            total = pd.concat(parts).groupby(level=0).sum() if len(parts) > 1 else parts[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(total)), pa.array(signed(total.index.to_numpy(np.uint64))), pa.array(total.to_numpy(np.int64))],
                names=["lang", "gram", "n"],
            )

    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for numbers, cut in blocks(batch.column("text").to_pylist()):
            found, piece = grams(*cut)
            of = langs[numbers]
            for lang in sorted(set(of)):
                own = found[(of == lang)[piece]]
                if len(own):
                    codes, distinct = pd.factorize(own)
                    held.setdefault(lang, []).append(pd.Series(np.bincount(codes), index=distinct))
                    size += len(distinct)
                    if len(held[lang]) >= 16:
                        before = sum(map(len, held[lang]))
                        held[lang] = [pd.concat(held[lang]).groupby(level=0).sum()]
                        size -= before - len(held[lang][0])
            if size > FLUSH:
                yield from summed()
                held, size = {}, 0
    yield from summed()


def _low(gram: Column, symbols: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << 16 * symbols) - 1)) if symbols < 4 else gram


def model_rows(learn: DataFrame) -> DataFrame:
    """``lang, kind, k, key, value``: discounted probability (kind 0) of each n-gram and weight (1) of each context of
    order k, from the ``lang, text`` rows to learn from."""
    counts = map_arrow(learn.select("lang", "text"), _counted, "lang string, gram long, n long")
    level = stored(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    rows = None
    for k in range(ORDER, 0, -1):
        if k < ORDER:
            level = level.groupBy("lang", _low(F.col("gram"), k).alias("gram")).agg(F.count("*").alias("n"))
        ones = level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
        # The discount n1 / (n1 + 2 n2); a half where no count is 1
        discount = ones.select("lang", F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5).alias("d"))
        own = level.withColumn("context", F.shiftrightunsigned("gram", 16))
        contexts = own.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("followers"))
        contexts = contexts.join(discount, "lang")
        seen = own.join(contexts, ["lang", "context"]).select(
            "lang", F.lit(0).alias("kind"), F.lit(k).alias("k"), F.col("gram").alias("key"),
            (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("value"),
        )
        weights = contexts.select(
            "lang", F.lit(1).alias("kind"), F.lit(k).alias("k"), F.col("context").alias("key"),
            (F.col("d") * F.col("followers") / F.col("total")).alias("value"),
        )
        part = seen.unionByName(weights)
        rows = part if rows is None else rows.unionByName(part)
    return rows


def _slots(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slot = slots(batch.column("key").to_numpy().view(np.uint64), bits)
        yield batch.set_column(batch.schema.get_field_index("key"), "key", pa.array(slot.astype(np.int64)))


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix(keys + np.uint64(1)) >> np.uint64(64 - bits)).astype(np.uint32)


class LanguageModels:
    """Sorted hash arrays of all languages."""

    def __init__(self, rows: pa.Table, bits: int):
        self.bits = bits
        frame = rows.to_pandas()
        self.langs = sorted(frame["lang"].unique())
        alphabet = frame[(frame.kind == 0) & (frame.k == 1)]["key"].nunique()
        self.unseen = 1.0 / (alphabet + 1)
        self.arrays = {}
        for (lang, kind, k), part in frame.groupby(["lang", "kind", "k"]):
            part = part.sort_values("key")
            self.arrays[lang, kind, k] = part["key"].to_numpy(np.uint32), part["value"].to_numpy(np.float32)

    def _look_up(self, lang: str, kind: int, k: int, slot: np.ndarray, missing: float) -> np.ndarray:
        keys, values = self.arrays[lang, kind, k]
        at = np.minimum(np.searchsorted(keys, slot), len(keys) - 1)
        return np.where(keys[at] == slot, values[at], np.float32(missing))

    def costs(self, distinct: np.ndarray) -> np.ndarray:
        """-log P of each n-gram's last symbol, per language (rows)."""
        out = np.empty((len(self.langs), len(distinct)))
        keys = [
            (slots(distinct & np.uint64((1 << 16 * k) - 1), self.bits), slots((distinct & np.uint64((1 << 16 * k) - 1)) >> _BITS, self.bits))
            for k in range(1, ORDER + 1)
        ]
        for i, lang in enumerate(self.langs):
            p = np.full(len(distinct), self.unseen)
            for k, (gram, context) in enumerate(keys, 1):
                p = self._look_up(lang, 0, k, gram, 0.0) + self._look_up(lang, 1, k, context, 1.0) * p
            out[i] = -np.log(np.minimum(p, 1.0))
        return out

    def sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cost per language (rows) and text, and the number of symbols of each text."""
        cost, n = np.zeros((len(self.langs), len(texts))), np.zeros(len(texts), np.int64)
        for numbers, cut in blocks(texts):
            found, piece = grams(*cut)
            if not len(found):
                continue
            of = np.asarray(numbers)[piece]
            n += np.bincount(of, minlength=len(texts))
            codes, distinct = pd.factorize(found)
            for i, each in enumerate(self.costs(distinct)):
                cost[i] += np.bincount(of, weights=each[codes], minlength=len(texts))
        return cost, n


SURE = 50  # symbols whose evidence the score counts at most: neighbouring symbols are not independent


def _scored(batches: Iterator[pa.RecordBatch], models) -> Iterator[pa.RecordBatch]:
    model = models.value
    for batch in batches:
        texts = batch.column("text").to_pylist()
        if model.langs:
            cost, n = model.sums(texts)
            entropy = cost / np.maximum(n, 1)
            best = entropy.argmin(axis=0)
            low = entropy[best, np.arange(len(texts))]
            score = 1 / np.exp(-(entropy - low) * np.minimum(n, SURE)).sum(axis=0)
            names = np.array(model.langs, object)[best]
        else:
            n = np.array([any(map(str.isalpha, t or "")) for t in texts], np.int64)
            low, score, names = np.zeros(len(texts)), np.zeros(len(texts)), np.full(len(texts), "und", object)
        none = n == 0
        names[none], score[none] = "und", 0.0
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("label"), pa.array(names, pa.string()), pa.array(score), pa.array(low), pa.array(n)],
            names=["row", "label", "lang_pred", "score", "entropy", "n_symbols"],
        )


def held_out(doc_id: Column) -> Column:
    """Documents that are never learnt from: crc32 of the identifier's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(learn: DataFrame, model_mb: int = 256) -> LanguageModels:
    """Models of the ``lang, text`` rows."""
    spark = learn.sparkSession
    rows = stored(model_rows(learn), "language-model")
    n_langs = max(1, rows.select("lang").distinct().count())
    entry = 8 * 2 * ORDER  # a hash and a value, of n-grams and contexts, of every order
    bits = min(22, int(np.log2(max(2, model_mb * 2**20 / (entry * n_langs)))))
    slotted = map_arrow(rows, partial(_slots, bits=bits), "lang string, kind int, k int, key long, value double")
    table = slotted.groupBy("lang", "kind", "k", "key").agg(F.max("value").cast("float").alias("value")).toArrow()
    return LanguageModels(table, bits)


def _judged(rows: DataFrame, z: float, model_mb: int) -> DataFrame:
    """``row, lang_pred, score, entropy, n_symbols, rejected`` of ``row, doc_id, text, lang`` rows. What ``row`` holds and
    the label only ride along with the scoring."""
    learnt = ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
    models = fit(rows.filter(learnt & F.col("text").isNotNull()), model_mb)
    labelled = rows.select("row", F.when(learnt, F.col("lang")).alias("label"), "text")
    schema = StructType([
        *labelled.drop("text").schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()),
        StructField("entropy", DoubleType()), StructField("n_symbols", LongType()),
    ])
    shared = rows.sparkSession.sparkContext.broadcast(models)
    scored = stored(map_arrow(labelled, partial(_scored, models=shared), schema), "language-scores")
    return scored.withColumn("rejected", _rejected(scored, models, z)).drop("label")


def _rejected(scored: DataFrame, models: LanguageModels, z: float) -> Column:
    """The calibrated rule: two numbers per learned language are all that is gathered."""
    right = scored.filter("label = lang_pred AND n_symbols > 0")
    means = dict(right.groupBy("lang_pred").agg(F.avg("entropy")).toArrow().to_pandas().itertuples(index=False, name=None))
    random = float(-np.log(models.unseen))
    if not means:
        return F.col("n_symbols") == 0
    mean = _by_language(means)
    squares = F.pow(F.col("entropy") - mean, 2) * F.col("n_symbols")
    spreads = dict(right.groupBy("lang_pred").agg(F.sqrt(F.avg(squares))).toArrow().to_pandas().itertuples(index=False, name=None))
    far = (F.col("entropy") - mean) * F.sqrt("n_symbols") > z * _by_language(spreads)
    return (F.col("n_symbols") == 0) | F.coalesce(far & (F.col("entropy") > (mean + 2 * random) / 3), F.lit(False))


def _by_language(values: dict[str, float]) -> Column:
    pairs = [F.lit(x) for item in sorted(values.items()) for x in item]
    return F.try_element_at(F.create_map(*pairs), F.col("lang_pred"))


def _rows(docs: DataFrame, row: Column, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    cast = {"doc_id": (id_col, "long"), "text": (text_col, "string"), "lang": (lang_col, "string")}
    return docs.select(row, *(F.col(c).cast(kind).alias(name) for name, (c, kind) in cast.items()))


def identify(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", z: float = 8.0, model_mb: int = 256
) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, entropy, n_symbols, rejected``."""
    only_id = F.struct(F.col(id_col).cast("long").alias("doc_id")).alias("row")
    judged = _judged(_rows(docs, only_id, id_col, text_col, lang_col), z, model_mb)
    return judged.select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score", "entropy", "n_symbols", "rejected"
    )


def accepted(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", z: float = 8.0, model_mb: int = 256
) -> DataFrame:
    """The documents, with all their columns, that are not rejected."""
    return _judged(_rows(docs, whole_row(docs), id_col, text_col, lang_col), z, model_mb).filter("NOT rejected").select("row.*")
