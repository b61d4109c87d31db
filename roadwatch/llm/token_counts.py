"""Token counts by section through character offsets.

A whole document is encoded once. The tokens' spans are joined with the
sections' spans (both sorted, so the interval join is two binary searches per
token, within the document's row), and a token that crosses a boundary goes
to the section that holds most of its bytes, the earlier one if they tie.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadwatch.llm import tokens
from roadwatch.llm.common import slices

#: Result rows per Arrow batch.
ROWS = 50_000
NAMES = ["section", "name", "start", "end", "n_tokens", "n_crossing"]


def attribute(starts: np.ndarray, ends: np.ndarray, sec_starts: np.ndarray, sec_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token span (-1: none) and whether it overlaps several sections.

    Sections are sorted and do not overlap; empty ones get nothing.
    """
    lo = np.searchsorted(sec_ends, starts, "right")
    hi = np.searchsorted(sec_starts, ends, "left") - 1
    owner = np.where(lo <= hi, lo, -1)
    crossing = lo < hi
    for i in np.flatnonzero(crossing):
        a, b = lo[i], hi[i] + 1
        owner[i] = a + np.argmax(np.minimum(sec_ends[a:b], ends[i]) - np.maximum(sec_starts[a:b], starts[i]))
    return owner, crossing


def lines(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sections of a text: its lines, each with the newline that ends it."""
    ends = np.flatnonzero(data == 10) + 1
    if not len(ends) or ends[-1] < len(data):
        ends = np.append(ends, len(data))
    return np.concatenate([[0], ends[:-1]]), ends


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_cols: list[str] | None = None, separator: str = "\n",
                 tokenizer: str | None = None) -> DataFrame:
    """``(id_col, section, name, start, end, n_tokens, n_crossing)``: a row per section.

    One text column (the default, ``text``): the sections are its lines,
    ``name`` is NULL. Several: the document is the columns joined by
    ``separator``, the sections are the columns, named; what lies between
    belongs to none. Spans are in code points of the document, end exclusive;
    ``n_crossing`` counts the section's tokens that also reach into another.
    A NULL text is empty; an empty document has one section of no tokens.
    Repeated rows and NULL ids give rows of their own; other columns of
    ``docs`` are ignored.
    """
    text_cols = text_cols or ["text"]
    path, pattern = tokenizer or tokens.tokenizer_path(tokens.BYTE_BPE), tokens.byte_pattern()
    sep = separator.encode()

    def run(batches):
        spans = tokens.ByteSpans(path, pattern)
        out: list[list] = [[] for _ in range(7)]
        held = 0

        def batch():
            ids, sec, name, *numbers = out
            return pa.RecordBatch.from_arrays(
                [pa.array([x for a in ids for x in a], pa.int64()), pa.array(np.concatenate(sec), pa.int32()),
                 pa.array([x for a in name for x in a], pa.string()), *(pa.array(np.concatenate(n), pa.int64()) for n in numbers)],
                [id_col, *NAMES])

        for b in slices(batches):
            fields = [b.column(k + 1).cast(pa.binary()) for k in range(len(text_cols))]
            for row, doc in enumerate(b.column(0).to_pylist()):
                parts = [f[row].as_py() or b"" for f in fields]
                text = sep.join(parts)
                data = np.frombuffer(text, np.uint8)
                if len(parts) == 1:
                    a, z = lines(data)
                else:
                    size = np.array([len(p) for p in parts])
                    z = np.cumsum(size + len(sep)) - len(sep)
                    a = z - size
                long = spans.lengths(text).astype(np.int64)
                ends = np.cumsum(long)
                owner, crossing = attribute(ends - long, ends, a, z)
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]) if not text.isascii() else None
                n = len(a)
                inside = owner >= 0
                for column, x in zip(out, ([doc] * n, np.arange(n), text_cols if len(parts) > 1 else [None] * n,
                                           a if points is None else points[a], z if points is None else points[z],
                                           np.bincount(owner[inside], minlength=n), np.bincount(owner[inside & crossing], minlength=n))):
                    column.append(x)
                held += n
                if held >= ROWS:
                    yield batch()
                    out, held = [[] for _ in range(7)], 0
        if held:
            yield batch()

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), *(F.col(c).cast("string").alias(f"t{i}") for i, c in enumerate(text_cols)))
    return rows.mapInArrow(run, f"`{id_col}` long, section int, name string, start long, end long, n_tokens long, n_crossing long")
