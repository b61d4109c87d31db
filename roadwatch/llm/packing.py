"""Variable-capacity best-fit packing of token sequences.

:func:`pack_tokens` encodes the texts and fills bins by tokens;
:func:`pack_documents` packs by any given size.

Pieces (documents, split where they exceed the largest length) are dealt by
hash into groups of bounded size, and each group is packed in one task. Pieces
go by falling size into the open bin with the least room that still fits.
Where none fits a bin is opened, and its length is chosen among all permitted
lengths by cost per token the bin can expect to hold, given the pieces still
to come; at the end every bin is cut down to the shortest permitted length
that holds its contents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadwatch.llm import tokens
from roadwatch.llm.common import cut, slices, word_count

LENGTHS = (512, 1024, 2048, 4096)
#: Pieces per group, on average: what one task packs at a time.
GROUP = 20_000
#: Cost of a sequence of length c: FIXED + c + QUADRATIC * c * c (padding and attention).
FIXED = 16.0
QUADRATIC = 1e-5
#: Bins of one group are numbered from ``group * BINS``.
BINS = 1 << 32


def cost(length: int) -> float:
    return FIXED + length + QUADRATIC * length * length


def pack(sizes: list[int], lengths=LENGTHS) -> list[tuple[int, int]]:
    """Bin and offset of each piece; ``sizes`` fall, each at most ``max(lengths)``."""
    lengths = sorted(lengths)
    # Total size of the pieces of size at most x not yet placed, by cumulated size.
    top = lengths[-1]
    later = np.zeros(top + 1, np.int64)
    for s in sizes:
        later[s] += s
    left = np.cumsum(later).tolist()
    done = 0  # of the current size, already placed
    bins_with: dict[int, list[int]] = {}  # room -> bins, the latest last
    rooms = 0  # bit r set: some bin has room r
    used: list[int] = []
    out = []
    last = None
    for s in sizes:
        if s != last:
            last, done = s, 0
        done += s
        fits = rooms >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            own = bins_with[room]
            b = own.pop()
            if not own:
                rooms &= ~(1 << room)
        else:
            # Larger pieces are all placed; of this size what is left, of smaller ones all.
            best, room = None, 0
            for c in lengths:
                if c >= s:
                    small = min(c - s, s)
                    rest = left[small] - (done if small >= s else 0)
                    rate = cost(c) / min(c, s + rest)
                    if best is None or rate < best - 1e-12:
                        best, room = rate, c
            b = len(used)
            used.append(0)
        out.append((b, used[b]))
        used[b] += s
        room -= s
        if room:
            bins_with.setdefault(room, []).append(b)
            rooms |= 1 << room
    return out


def pack_documents(docs: DataFrame, id_col: str = "doc_id", size: Column | None = None, lengths=LENGTHS,
                   group: int = GROUP) -> DataFrame:
    """``(id_col, piece, start, size, bin_id, offset, length)``: a row per piece.

    ``size`` defaults to the number of words of ``text``; bins filled by words
    hold more tokens than their length (:func:`pack_tokens` fills by tokens). A
    document longer than the largest length is split into pieces of that length
    and a rest; ``start`` is the piece's first unit in the document, ``offset``
    its place in the bin, ``length`` the bin's final length. Documents of size 0
    or NULL have one piece of size 0 with NULL ``bin_id``, ``offset`` and
    ``length``. Repeated rows and rows with a NULL id are packed like any others;
    ties are broken by id and piece. Bins depend on the rows alone, not on their
    files or partitions.
    """
    top = max(lengths)
    sized = docs.select(F.col(id_col).alias("id"), F.coalesce(size if size is not None else word_count(F.col("text")), F.lit(0)).cast("long").alias("n"))
    sized = sized.groupBy("id", "n").agg(F.count("*").alias("rows")).withColumn("salt", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    pieces = sized.select("id", "n", "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.expr(f"(n - 1) div {top}")))).alias("piece")) \
        .select("id", "salt", F.col("piece").cast("int").alias("piece"), (F.col("piece") * top).alias("start"),
                F.least(F.lit(top), F.col("n") - F.col("piece") * top).cast("int").alias("size"), F.lit(None).cast("long").alias("words"))
    return _pack_pieces(pieces, lengths, group).drop("words").withColumnRenamed("id", id_col)


def pack_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths=LENGTHS, group: int = GROUP,
                tokenizer: str | None = None) -> DataFrame:
    """``(id_col, piece, start, size, words, bin_id, offset, length)``: a row per piece.

    As :func:`pack_documents`, with the ids of the word BPE as the unit: a
    document's tokens are those that ``token_output.write_tokens`` writes, the
    end id included, and ``start``, ``size`` and ``offset`` count them. ``words``
    is the number of words that begin in the piece. Texts without tokens (NULL,
    empty or white space) hold nothing to learn: they have size 0 and no bin
    here, while a token file holds their end id. Bins depend on the rows alone,
    not on their files or partitions.
    """
    top = max(lengths)
    tokenizer = tokenizer or tokens.tokenizer_path(tokens.WORD_BPE)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        encoder = tokens.worker_encoder(tokenizer)
        for b in slices(batches, 2048):
            n, held = encoder.count(b.column(1))
            n += n > 0  # the end id
            words = [[w] for w in held.tolist()]
            for i in np.flatnonzero(n > top).tolist():
                words[i] = np.bincount(encoder.word_starts(b.column(1)[i].as_py()) // top, minlength=-(-int(n[i]) // top)).tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n), pa.array(words, pa.list_(pa.int64()))], ["id", "h", "n", "words"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sized = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("h")).mapInArrow(run, f"id {kind}, h long, n long, words array<long>")
    # Equal rows are told apart by their number, whatever files and partitions they came in.
    sized = sized.groupBy("id", "h", "n", "words").agg(F.count("*").alias("rows")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    pieces = sized.select("id", "n", F.struct("h", "copy").alias("salt"), F.posexplode("words").alias("piece", "words")) \
        .select("id", "salt", "piece", (F.col("piece").cast("long") * top).alias("start"),
                F.least(F.lit(top), F.col("n") - F.col("piece").cast("long") * top).cast("int").alias("size"), "words")
    return _pack_pieces(pieces, lengths, group).select(F.col("id").alias(id_col), "piece", "start", "size", "words", "bin_id", "offset", "length")


def _pack_pieces(pieces: DataFrame, lengths, group: int) -> DataFrame:
    """``pieces`` ``(id, salt, piece, start, size, words)`` with ``bin_id``, ``offset`` and
    ``length``; the salt tells equal rows apart."""
    lengths = sorted(set(lengths))
    kind = pieces.schema["id"].dataType.simpleString()
    pieces = cut(pieces)
    groups = max(1, -(-pieces.where("size > 0").count() // group))
    keyed = pieces.where("size > 0").withColumn("g", F.pmod(F.xxhash64("id", "piece", "size", "salt"), F.lit(groups)).cast("int")).drop("salt")

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("size", "descending"), ("id", "ascending"), ("piece", "ascending"), ("words", "ascending")])
        where = pack(t.column("size").to_pylist(), lengths)
        bins = np.array([b for b, _ in where])
        filled = np.bincount(bins, weights=t.column("size").to_numpy())
        final = np.array(lengths)[np.searchsorted(lengths, filled)]
        g = t.column("g")[0].as_py()
        return pa.table([*(t.column(c) for c in ("id", "piece", "start", "size", "words")), pa.array(g * BINS + bins, pa.int64()),
                         pa.array([o for _, o in where], pa.int32()), pa.array(final[bins], pa.int32())],
                        names=["id", "piece", "start", "size", "words", "bin_id", "offset", "length"])

    packed = keyed.groupBy("g").applyInArrow(run, f"id {kind}, piece int, start long, size int, words long, bin_id long, offset int, length int")
    empty = pieces.where("size = 0").select("id", "piece", "start", "size", "words", F.lit(None).cast("long").alias("bin_id"),
                                            F.lit(None).cast("int").alias("offset"), F.lit(None).cast("int").alias("length"))
    return packed.unionByName(empty)
