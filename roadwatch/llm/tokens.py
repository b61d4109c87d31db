"""Exact whole-text encoding with the public tokenizers, remembered word by word.

Both encoders cut a text only where the tokenizer's own pre-tokenizer must
cut it, encode each distinct piece once (a two-generation memory of bounded
size, per task or worker) and put the pieces together; texts with characters
for which that is not certain are encoded whole by the library.
"""

from __future__ import annotations

import base64
import os
import re
import struct
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from roadwatch.llm.common import WORD

#: Pieces remembered per generation; a memory holds at most two generations.
GENERATION = 250_000
#: Characters of the longest word piece remembered, since a worker's memory outlives its tasks.
LONGEST = 100
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.tiktoken"


class Memory(dict):
    """``memory[piece]`` computes a missing piece; old pieces are forgotten by generation,
    those of more than ``longest`` characters at once."""

    def __init__(self, make, longest: int = sys.maxsize):
        self.make, self.longest, self.old = make, longest, {}

    def __missing__(self, piece):
        value = self.old.get(piece)
        if value is None:
            value = self.make(piece)
            if len(piece) > self.longest:
                return value
        if len(self) >= GENERATION:
            self.old = dict(self)
            self.clear()
        self[piece] = value
        return value


class WordEncoder:
    """Ids of the lower-casing word BPE (``word_bpe_49k.json``) by the tokenizers library.

    Its pre-tokenizer keeps the matches of a pattern on the NFC, lower-cased
    text; each match is encoded on its own. For texts of ASCII, precomposed
    Latin letters below U+0180 and common punctuation the matches are found
    here and each is given to the library's BPE model; any other text, and any
    that holds a special token's spelling, is encoded whole.
    """

    # The pre-tokenizer's alternatives, for the characters below.
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\sa-z0-9ß-öø-ſ]+", re.ASCII)
    LINE_PIECES = re.compile(PIECES.pattern + "|\n", re.ASCII)
    #: Stands for the line feed between words, which is no token.
    BETWEEN = b"\xff\xff\xff\xff"
    OTHER = re.compile("[^\x00-\x7f¡-©«-±´¶-¸»¿-įı-ſ‐-‧‰-⁞]|<\\|")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.memory = Memory(self._piece, LONGEST)
        self.piece_sizes = Memory(self._piece_size)
        # The byte-level alphabet: printable bytes stand for themselves, others for U+0100 on.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        self.alphabet = "".join(chr(b if b in plain else next(others)) for b in range(256))

    def _tokens(self, piece: str) -> list:
        # Visible ASCII stands for itself.
        plain = piece.isascii() and piece.isprintable()
        return self.model.tokenize(piece if plain else piece.encode().decode("latin-1").translate(self.alphabet))

    def _piece(self, piece: str) -> bytes:
        if piece == "\n":
            return self.BETWEEN
        ids = [t.id for t in self._tokens(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece_size(self, piece: str) -> int:
        if piece == "\n":
            return -1  # between words
        return len(self._tokens(piece))

    def _sizes(self, words: list[str]) -> np.ndarray:
        """Number of ids of each word; -1 if texts with it are encoded whole. No piece crosses
        white space, so words are cut in one go."""
        if not words:
            return np.zeros(0, np.int64)
        joined = "\n".join(words)
        if self.OTHER.search(joined):
            plain = np.array([not self.OTHER.search(w) for w in words])
            out = np.full(len(words), -1, np.int64)
            out[plain] = self._sizes([w for w, ok in zip(words, plain.tolist()) if ok])
            return out
        n = np.array(list(map(self.piece_sizes.__getitem__, self.LINE_PIECES.findall(joined.lower()))), np.int64)
        ends = np.append(np.flatnonzero(n < 0), len(n))
        return np.diff(np.concatenate([[0], np.cumsum(np.maximum(n, 0))])[ends], prepend=0)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()

    def _ids(self, words: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
        """The ids of each word, and which words have their texts encoded whole (no ids here).
        No piece crosses white space, so words are cut in one go."""
        def lines(w: pa.Array) -> str:
            return pc.binary_join(pa.ListArray.from_arrays([0, len(w)], w), "\n")[0].as_py() + "\n" * (len(w) > 0)

        whole = np.zeros(len(words), bool)
        joined = lines(words)
        if self.OTHER.search(joined):
            whole = np.array([self.OTHER.search(w) is not None for w in joined.split("\n")[:-1]])
            joined = lines(pc.if_else(pa.array(whole), "", words))
        found = np.frombuffer(b"".join(map(self.memory.__getitem__, self.LINE_PIECES.findall(joined.lower()))), "<u4")
        between = found == np.frombuffer(self.BETWEEN, "<u4")
        ends = np.flatnonzero(between) - np.arange(len(words))
        return pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), found[~between]), whole

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text (no NULLs): a batch's distinct words are encoded once each."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
        coded = split.values.dictionary_encode()
        each, whole = self._ids(coded.dictionary)
        taken = each.take(coded.indices)
        offsets = split.offsets.to_numpy()
        ids, bounds = taken.values.to_numpy(), taken.offsets.to_numpy()[offsets].tolist()
        out = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        if whole.any():
            n = np.concatenate([[0], np.cumsum(whole[coded.indices.to_numpy()])])[offsets]
            for i in np.flatnonzero(np.diff(n)).tolist():
                out[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4")
        return out

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids and of words (:data:`common.WORD`) of each text (no NULLs): a batch's
        distinct words are counted once each."""
        split = pc.ascii_split_whitespace(texts.cast(pa.string()))
        offsets = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()
        each = self._sizes(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        word = pc.not_equal(pc.binary_length(split.values), 0).to_numpy(zero_copy_only=False)  # white space at an end splits off an empty string

        def per_text(x: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(x)])[offsets])

        n = per_text(each)
        for i in np.flatnonzero(per_text(each < 0)).tolist():
            n[i] = len(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids)
        return n, per_text(word)

    def word_starts(self, text: str) -> np.ndarray:
        """Number of the token that each word (:data:`common.WORD`) of a text with tokens begins in;
        a word without tokens counts for the next one that has some, or the last."""
        if "<|" in text if text.isascii() else self.OTHER.search(text):
            at = [a for a, _ in self.tokenizer.encode(text, add_special_tokens=False).offsets]
        else:
            at = []
            for m in self.PIECES.finditer(text.lower()):
                at += [m.start()] * (len(self.memory[m.group()]) // 4)
        begins = [m.start() for m in re.finditer(WORD, text)]
        return np.minimum(np.searchsorted(np.maximum.accumulate(at), begins, "left"), len(at) - 1)


def worker_encoder(path: str) -> WordEncoder:
    """The worker process's :class:`WordEncoder`: the next task in it finds the memory filled.

    Held by ``sys``, since this module is shipped by value with every task.
    """
    held = sys.__dict__.setdefault("_roadwatch_encoders", {})
    if path not in held:
        held[path] = WordEncoder(path)
    return held[path]


class ByteSpans:
    """Byte lengths of the tokens of the byte-level BPE (``byte_bpe_50k.tiktoken``) by tiktoken.

    Byte-level tokens tile the text, so lengths give every token's span. Its
    pattern starts a new piece at each space before a visible character and at
    white-space runs; those pieces are remembered. Texts with white space
    beyond ASCII are encoded whole.
    """

    RUNS = re.compile(rb" ?[^\s]+|\s+(?!\S)|\s+")
    PAIR = re.compile(rb"\s\s")
    WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

    def __init__(self, path: str, pattern: str):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, np.uint16)
        for token, i in ranks.items():
            self.length[i] = len(token)
        self.exact = Memory(self._lengths)
        self.spaced = Memory(lambda piece: self._lengths(b" " + piece))

    def _lengths(self, piece: bytes) -> bytes:
        return self.length[self.encoding.encode_ordinary(piece.decode())].tobytes()

    def lengths(self, text: bytes) -> np.ndarray:
        if not text.isascii() and self.WIDE_SPACE.search(text):
            found = self._lengths(text)
        elif self.PAIR.search(text):
            memory = self.exact
            found = b"".join([memory[p] for p in self.RUNS.findall(text)])
        else:
            first, *rest = text.split(b" ")
            memory = self.spaced
            found = (self.exact[first] if first else b"") + b"".join([memory[p] for p in rest])
        return np.frombuffer(found, np.uint16)


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN
