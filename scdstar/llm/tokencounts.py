"""Token counts: offset-mapped attribution of tokens to the sections of a document.

A document is encoded once, whole, so tokens are those that a model sees. Each token has a span
of code points; sections have spans too; an interval join of the two sorted lists
(two binary searches for all tokens of a document) finds which section owns which token. A token
over a boundary is allocated by an explicit rule:

* ``start``: to the section of its first code point;
* ``most``: to the section with most of its code points, the earlier one of equals;
* ``split``: to every section it touches, by share of code points, as exact fractions would
  be lost in floats, in units of 1/``UNITS`` with the remainder to the earliest.

Spans come from the widths of a byte-level tokenizer's ids, whose bytes are the text's
bytes, or from the library's offsets for other tokenizers. A token of a part of a character has
the span of the whole character.

Sections are lines by default, each with the line break that ends it; or any spans given as
``sections`` arrays of ``(name, start, end)``. Code points in no section are counted under the
section ``-1`` with a null name, so that the counts of a document always add up to its tokens.

Defined results: a null or empty text has one empty section and no tokens; an empty section
has zero tokens; repeated rows are counted each; a null ``doc_id`` is kept. Further columns are
ignored. Memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scdstar.llm.encoder import Encoder, encoder
from scdstar.llm.shingles import arrow_batches

RULES = ("start", "most", "split")
#: Units of a token that rule ``split`` deals out: whole for up to ten sections a token.
UNITS = 2520


def spans(text: str, encode: Encoder, ids: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """First and one-past-last code point of each token."""
    if not encode.byte_level or ids is None:
        found = encode.library.encode_batch([text], add_special_tokens=False)[0].offsets
        both = np.array(found, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]
    ends = np.cumsum(encode.width[ids])
    starts = ends - encode.width[ids]
    if len(ends) and ends[-1] == len(text):  # one byte a code point
        return starts, ends
    raw = np.frombuffer(text.encode(), np.uint8)
    point = np.cumsum((raw & 0xC0) != 0x80)  # code points up to and with each byte
    return point[starts] - 1, point[ends - 1]


def lines(text: str) -> np.ndarray:
    """Where lines start, and the end of the last."""
    breaks = [0]
    at = text.find("\n")
    while at >= 0:
        breaks.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array([*breaks, len(text)], np.int64)


def allocate(first: np.ndarray, last: np.ndarray, edges: np.ndarray, rule: str) -> np.ndarray:
    """Units of tokens with spans ``[first, last)`` for each section between ``edges``
    (sorted, from 0 to the end of the text)."""
    sections = len(edges) - 1
    # The section of a code point is the last to start at or before it, and to be not empty.
    low = np.clip(np.searchsorted(edges, first, "right") - 1, 0, sections - 1)
    high = np.clip(np.searchsorted(edges, np.maximum(last - 1, first), "right") - 1, 0, sections - 1)
    high = np.maximum(low, high)
    out = np.bincount(low[low == high], minlength=sections) * UNITS
    for k in np.flatnonzero(low != high).tolist():
        a, b, i, j = int(first[k]), int(last[k]), int(low[k]), int(high[k])
        if rule == "start":
            out[i] += UNITS
            continue
        parts = np.minimum(edges[i + 1 : j + 2], b) - np.maximum(edges[i : j + 1], a)
        if rule == "most":
            out[i + int(np.argmax(parts))] += UNITS
        else:
            share = parts * UNITS // (b - a)
            share[0] += UNITS - int(share.sum())
            out[i : j + 1] += share
    return out


def _counted(definition, rule: str, given: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(definition.value)
        for batch in batches:
            numbers, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lists = batch.column(2).to_pylist() if given else [None] * len(texts)
            ids = encode.encode(texts) if encode.byte_level else [None] * len(texts)
            docs: list = []
            out: list[list] = [[], [], [], [], []]
            for doc, text, sections, own in zip(numbers, texts, lists, ids):
                text = text or ""
                first, last = spans(text, encode, own)
                if sections is None:
                    edges = lines(text)
                    names = [None] * (len(edges) - 1)
                    order = range(len(edges) - 1)
                else:
                    edges, names, order = _tiled(sections, len(text))
                units = allocate(first, last, edges, rule)
                docs.extend([doc] * len(units))
                for column, values in zip(out, (order, names, edges[:-1].tolist(), edges[1:].tolist(), units.tolist())):
                    column.extend(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(out[0], pa.int32()), pa.array(out[1], pa.string()),
                 *(pa.array(c, pa.int64()) for c in out[2:])],
                ["doc_id", "section", "name", "start", "end", "units"],
            )

    return run


def _tiled(sections: list[dict], length: int) -> tuple[np.ndarray, list, list[int]]:
    """Given spans in order, with what lies between them as sections ``-1``. Overlaps go to
    the section that starts first."""
    edges, names, order, at = [0], [], [], 0
    for k, s in sorted(enumerate(sections), key=lambda x: (x[1]["start"], x[0])):
        start, end = min(max(s["start"], at), length), min(max(s["end"], at), length)
        if start > at:
            edges.append(start), names.append(None), order.append(-1)
        edges.append(max(start, end)), names.append(s["name"]), order.append(k)
        at = edges[-1]
    if at < length or not order:
        edges.append(length), names.append(None), order.append(-1)
    return np.array(edges, np.int64), names, order


def token_counts(docs: DataFrame, tokenizer: str, rule: str = "start") -> DataFrame:
    """One row for each section of each row of ``docs(doc_id, text)``, or ``docs(doc_id, text,
    sections)`` with an array of ``(name, start, end)``: ``doc_id``, ``section``, ``name``,
    ``start``, ``end`` and ``units``, 1/``UNITS`` of a token each. ``tokenizer`` is the path of a
    definition for the tokenizers library."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    spark = docs.sparkSession
    arrow_batches(spark)
    definition = spark.sparkContext.broadcast(Path(tokenizer).read_text("utf-8"))
    given = "sections" in docs.columns
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", *(["sections"] if given else [])
    ).mapInArrow(
        _counted(definition, rule, given),
        "doc_id bigint, section int, name string, start bigint, end bigint, units bigint",
    )
