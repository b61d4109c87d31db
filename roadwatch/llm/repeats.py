"""Substring dedup by seed and extend.

Every run of :data:`LENGTH` words holds a winnowed anchor: of its k-word
shingles the one of least hash, the first if tied (Schleimer, Wilkerson and
Aiken, 2003). Two documents that share such a run share its anchor at the same
place in it, so documents are joined on anchors, and only anchors that occur
in two documents are extended, both ways, to the windows they stand for. Runs
of matched windows are the maximal repeats of at least :data:`LENGTH` words.

Neither step makes pairs of documents. Per key (anchor or window) one
map-side combined minimum names the first document that holds it, and only
that document is told: "no other document has this anchor", "you hold this
window first". What a document is not told it can conclude, so a document
receives at most as many rows as it has windows, however often a passage
repeats elsewhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadwatch.llm.common import slices

#: Words of a window, and of an anchor.
LENGTH, ANCHOR = 13, 5
#: Bytes of text that are hashed at a time, and the length from which a single word is hashed by itself.
BLOCK, LONG_WORD = 1 << 22, 1 << 12

# Odd multipliers of the two hash lanes, per byte and per word.
_BYTE = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_WORD = (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def cut_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without space and U+0009..U+000D) of a column of texts without
    NULLs: all bytes, starts and ends in them, and each text's first word (one
    entry more than texts)."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        z = np.zeros(0, np.int64)
        return data, z, z, np.zeros(len(column) + 1, np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]  # words end with their text
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return data, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes per word: polynomials of its bytes, by prefix sums; long words by XXH3."""
    out = np.zeros((2, len(starts)), np.uint64)
    size = (ends - starts).astype(np.uint64)
    inverse = [np.uint64(pow(b, -1, 1 << 64)) for b in _BYTE]
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK, "right")))
        a, z = int(starts[at]), int(ends[to - 1])
        if z - a <= BLOCK:
            part = data[a:z].astype(np.uint64) + np.uint64(1)
            s, e = starts[at:to] - a, ends[at:to] - a
            for lane, b in enumerate(_BYTE):
                power = np.full(z - a, np.uint64(b))
                power[0] = 1
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * np.cumprod(power))])
                back = np.full(z - a, inverse[lane])
                back[0] = 1
                out[lane, at:to] = (total[e] - total[s]) * np.cumprod(back)[s]
        at = to
    for lane in range(2):
        out[lane] = _mixed(out[lane] + size * np.uint64(_WORD[lane]))
    if (size >= LONG_WORD).any():
        import xxhash
        for i in np.flatnonzero(size >= LONG_WORD).tolist():
            h = xxhash.xxh3_128_intdigest(data[starts[i]:ends[i]].tobytes())
            out[:, i] = h & (1 << 64) - 1, h >> 64
    return out[0], out[1]


def rolled(h: np.ndarray, k: int, lane: int) -> np.ndarray:
    """A hash of each ``k`` consecutive word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(_WORD[lane]) + h[j:n + j]
    return _mixed(out)


class Windows:
    """Anchors and windows of a column of texts (no NULLs)."""

    def __init__(self, texts: pa.Array, length: int, anchor: int):
        self.data, self.starts, self.ends, self.first = cut_words(texts)
        a, b = word_hashes(self.data, self.starts, self.ends)
        self.length, w = length, length - anchor + 1
        owner = np.repeat(np.arange(len(texts)), np.diff(self.first))
        at = np.arange(max(0, len(a) - length + 1))
        #: The first words of all windows, by text, and each one's text.
        self.at = at[owner[at] == owner[at + length - 1]] if len(at) else at
        self.text = owner[self.at]
        self.bounds = np.searchsorted(self.text, np.arange(len(texts) + 1))
        shingle = rolled(a, anchor, 0)
        n = max(0, len(shingle) - w + 1)
        low, best = shingle[:n].copy(), np.zeros(n, np.int64)
        for j in range(1, w):
            less = shingle[j:n + j] < low
            low[less] = shingle[j:n + j][less]
            best[less] = j
        #: Each window's anchor (hash) and the anchor's first word.
        self.anchor, self.place = low[self.at].view(np.int64), (self.at + best[self.at])
        self.key = rolled(a, length, 0)[self.at].view(np.int64), rolled(b, length, 1)[self.at].view(np.int64)

    def open(self, single: list) -> np.ndarray:
        """Whether each window's anchor is in another document too, given every text's single anchors."""
        return ~self._known(self.anchor, single)

    def _known(self, values: np.ndarray, told: list) -> np.ndarray:
        out = np.zeros(len(values), bool)
        for i, known in enumerate(told):
            if known is not None and len(known):
                s = slice(self.bounds[i], self.bounds[i + 1])
                out[s] = np.isin(values[s], known)
        return out

    def short_key(self) -> np.ndarray:
        return self.key[0] ^ self.key[1]

    def covered(self, windows: np.ndarray) -> np.ndarray:
        """Whether each word lies in one of the marked windows."""
        steps = np.zeros(len(self.starts) + 1, np.int64)
        steps[self.at[windows]] += 1  # windows start at different words
        steps[self.at[windows] + self.length] -= 1
        return np.cumsum(steps[:-1]) > 0


def _lists(column: pa.Array) -> list:
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(
        [0 if n is None else n for n in pc.list_value_length(column).to_pylist()])])
    return [flat[a:z] for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``(id_col, n_words, repeats, kept)``: one row per row of ``docs``.

    ``repeats`` are the maximal runs of words (``start``, ``end``: word numbers
    from 0, end exclusive) covered by windows of ``length`` words that also
    start in a document of smaller id; ``kept`` is the text of all other words,
    joined by single spaces. Windows are judged on the input. NULL and empty
    texts have no words and an empty ``kept``. Rows under one id are one
    document: they remove nothing from each other. Rows without an id keep all
    words and remove nothing elsewhere, since they are neither smaller nor
    larger. Repeated rows are returned as often as they come in; other columns
    are ignored.

    Words and windows are compared by hashes of 128 bits (an anchor's 64 bits
    only select windows). Texts that equal one of a smaller id are settled by
    their digest; one text per distinct text is taken apart. A document's
    windows are held in one task.
    """
    if not 1 <= anchor <= length:
        raise ValueError("an anchor has at least one word and no more than a window")
    named = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    texts = named.select("id", "text", F.unhex(F.md5("text")).alias("digest"))
    # The texts of which a document holds the first copy: their digests go to that document.
    firsts = texts.groupBy("digest").agg(F.min("id").alias("id")).groupBy("id").agg(F.collect_list("digest").alias("__firsts"))
    base = texts.join(firsts, "id", "left").select("id", "text", F.coalesce(F.array_contains("__firsts", F.col("digest")), F.lit(False)).alias("first"))

    def anchors(batches):
        for b in slices(batches):
            b = b.filter(b.column("first"))
            w = Windows(b.column("text"), length, anchor)
            new = np.ones(len(w.at), bool)  # neighbours mostly share an anchor
            new[1:] = (w.place[1:] != w.place[:-1]) | (w.text[1:] != w.text[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(w.anchor[new]), b.column("id").take(pa.array(w.text[new]))], ["h", "id"])

    single = base.mapInArrow(anchors, f"h long, id {kind}").groupBy("h").agg(F.min("id").alias("id"), F.max("id").alias("__last")) \
        .where(F.col("id") == F.col("__last")).groupBy("id").agg(F.collect_list("h").alias("single"))
    seeded = base.join(single, "id", "left")

    def windows(batches):
        for b in slices(batches):
            b = b.filter(b.column("first"))
            w = Windows(b.column("text"), length, anchor)
            on = w.open(_lists(b.column("single")))
            yield pa.RecordBatch.from_arrays([pa.array(w.key[0][on]), pa.array(w.key[1][on]), b.column("id").take(pa.array(w.text[on]))], ["k", "k2", "id"])

    own = seeded.mapInArrow(windows, f"k long, k2 long, id {kind}").groupBy("k", "k2").agg(F.min("id").alias("id")) \
        .groupBy("id").agg(F.collect_list(F.col("k").bitwiseXOR(F.col("k2"))).alias("own"))

    def finish(batches):
        for b in slices(batches):
            w = Windows(b.column("text"), length, anchor)
            first = b.column("first").to_numpy(zero_copy_only=False)
            gone = ~first[w.text]  # a copy of an earlier document's text: all its windows start there
            gone |= w.open(_lists(b.column("single"))) & ~w._known(w.short_key(), _lists(b.column("own")))
            yield _result(w, w.covered(gone), b.column("id"), b.column("text"))

    schema = f"id {kind}, n_words long, repeats array<struct<start:int,end:int>>, kept string"
    done = seeded.join(own, "id", "left").mapInArrow(finish, schema)

    def untouched(batches):
        for b in slices(batches):
            w = Windows(b.column("text"), length, anchor)
            yield _result(w, np.zeros(len(w.starts), bool), b.column("id"), b.column("text"))

    unnamed = docs.where(F.col(id_col).isNull()).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return done.unionByName(unnamed.mapInArrow(untouched, schema)).withColumnRenamed("id", id_col)


def _result(w: Windows, gone: np.ndarray, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    first = w.first
    edge = gone.copy()
    edge[1:] &= ~gone[:-1]
    edge[first[:-1][first[:-1] < len(gone)]] |= gone[first[:-1][first[:-1] < len(gone)]]
    last = gone.copy()
    last[:-1] &= ~gone[1:]
    ends = first[1:][first[1:] > 0] - 1
    last[ends] |= gone[ends]
    starts, stops = np.flatnonzero(edge), np.flatnonzero(last) + 1
    offsets = np.searchsorted(starts, first)
    base = np.repeat(first[:-1], np.diff(offsets))
    spans = pa.StructArray.from_arrays([pa.array((starts - base).astype(np.int32)), pa.array((stops - base).astype(np.int32))], ["start", "end"])
    kept = []
    for i, t in enumerate(texts.cast(pa.large_binary()).to_pylist()):
        a, z = first[i], first[i + 1]
        words = t.split()
        if offsets[i] < offsets[i + 1]:
            words = [x for x, g in zip(words, gone[a:z].tolist()) if not g]
        kept.append(b" ".join(words).decode())
    return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), spans), pa.array(kept, pa.string())],
                                      ["id", "n_words", "repeats", "kept"])
