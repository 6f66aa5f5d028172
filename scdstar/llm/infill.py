"""Fill-in-middle transformation: texts cut at unit bounds into prefix, middle and suffix.

A unit is a run of white space with the visible run after it; white space that ends a text is
a unit of its own. Where to cut is drawn from a hash of ``doc_id``, as numbers of units.

Units are never listed. The characters of a group of whole texts become a wavelet matrix over
classes: what kind of character it is, and whether it begins a run. The ranks of the
visible kinds that begin a run add up to the number of units, those of the white kinds to the
bounds before a place, and bisection on these ranks finds both cuts of all texts at once.
The cuts go back to Spark, which puts the output together.

Output: ``plain`` is the text; ``psm`` is ``<P>prefix<S>suffix<M>middle`` and ``spm``
``<S>suffix<P>prefix<M>middle``. Texts that hold a sentinel stay plain, so ``restored`` is exact.

Defined results: null is an empty text; empty texts are plain with no unit. Blank texts are one
unit. Repeated rows are cut alike, as the draw depends on the id alone; a null ``doc_id`` is
drawn as an empty one. Further columns are ignored. Memory: a group of texts has at most
``GROUP`` characters, or is one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdstar.llm.shingles import arrow_batches
from scdstar.llm.wavelet import WaveletMatrix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Per cent of documents that are transformed, and of those that put the suffix first.
RATE, SUFFIX_FIRST = 50, 80
#: Characters of the texts that share a matrix.
GROUP = 1 << 20

# Classes of characters; those that begin a run have BEGINS added.
BLANK, BREAK, LETTER, DIGIT, SIGN, OTHER = range(6)
BEGINS = 8
WHITE_RUNS = (BLANK + BEGINS, BREAK + BEGINS)
VISIBLE_RUNS = tuple(kind + BEGINS for kind in (LETTER, DIGIT, SIGN, OTHER))


@cache
def _kinds() -> np.ndarray:
    kinds = np.full(129, OTHER, np.uint8)  # the last one is all beyond ASCII
    for code in range(128):
        c = chr(code)
        kinds[code] = (
            BLANK if c in " \t" else BREAK if c in "\n\x0b\x0c\r"
            else LETTER if c.isalpha() else DIGIT if c.isdigit() else SIGN
        )
    return kinds


def classes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all characters of ``texts``, one text after another, and where each begins."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    found = _kinds()[np.minimum(codes, 128)]
    white = found <= BREAK
    begins = np.ones(len(found), bool)
    np.not_equal(white[1:], white[:-1], out=begins[1:])
    begins[starts[:-1][starts[:-1] < len(found)]] = True
    return found + (begins * np.uint8(BEGINS)), starts


def cuts(texts: list[str], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Of each text its number of units n, and the characters before ``first % (n + 1)`` and
    ``second % (n + 1)`` units, the smaller one first; as three rows."""
    found, starts = classes(texts)
    begin, end = starts[:-1], starts[1:]
    matrix = WaveletMatrix(found, 4)
    units = np.diff(matrix.ranks(VISIBLE_RUNS, starts))
    some = end > begin
    units[some] += found[end[some] - 1] % BEGINS <= BREAK  # white space at the end
    out = [units]
    # A text's first character bounds no unit, even if it is white.
    earlier = matrix.ranks(WHITE_RUNS, np.minimum(begin + 1, end))
    a, b = first % (units + 1), second % (units + 1)
    for wanted in (np.minimum(a, b), np.maximum(a, b)):
        # A bound is before the white character that begins a run; a text's end needs none.
        place = matrix.locate(WHITE_RUNS, earlier + wanted, np.minimum(begin + 1, end), end + 1) - 1
        place = np.where(wanted == 0, begin, np.where(wanted == units, end, place))
        out.append(place - begin)
    return np.stack(out)


def groups(texts: list[str], most: int) -> Iterator[slice]:
    """Neighbouring texts with at most ``most`` characters in all, or one longer text."""
    start = size = 0
    for k, text in enumerate(texts):
        if k > start and size + len(text) > most:
            yield slice(start, k)
            start, size = k, 0
        size += len(text)
    if texts:
        yield slice(start, len(texts))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        first, second = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("first", "second"))
        found = [cuts(texts[g], first[g], second[g]) for g in groups(texts, GROUP)]
        rows = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "text", "form")), *map(pa.array, rows)],
            ["doc_id", "text", "form", "n", "prefix_chars", "second_cut"],
        )


def draws(seed: int, key: Column, n: int) -> list[Column]:
    """``n`` numbers below 2^32 from the SHA-256 of ``seed:key``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(n)]


def transform(docs: DataFrame, seed: int = 42) -> DataFrame:
    """``doc_id``, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` (null if plain) and
    ``output``, one row per row of ``docs(doc_id, text)``."""
    arrow_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    first, second, third, fourth = draws(seed, F.col("doc_id"), 4)
    held = text == ""
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        held |= F.contains(text, F.lit(sentinel))
    form = (
        F.when(held | (third % 100 >= RATE), "plain")
        .when(fourth % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    )
    cut = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), form.alias("form"),
        first.alias("first"), second.alias("second"),
    ).mapInArrow(
        _cut, "doc_id bigint, text string, form string, n bigint, prefix_chars bigint, second_cut bigint"
    )
    whole, a, b = F.col("text"), F.col("prefix_chars").cast("int"), F.col("second_cut").cast("int")
    prefix, middle = F.substring(whole, F.lit(1), a), F.substring(whole, a + 1, b - a)
    suffix = F.substring(whole, b + 1, F.length(whole) - b)
    plain = F.col("form") == "plain"
    output = (
        F.when(plain, whole)
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    return cut.select(
        "doc_id", "n", "form",
        F.when(~plain, F.col("prefix_chars")).alias("prefix_chars"),
        F.when(~plain, F.col("second_cut") - F.col("prefix_chars")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. No part holds a sentinel, so each occurs once."""
    parts = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
    )
