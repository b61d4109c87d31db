"""Secret scan through a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived:
every text the expression can match satisfies it. Texts are scanned in
segments (blocks of an Arrow batch). A segment gets an inverted index, a
sorted posting list of its texts for each trigram the queries mention; the
lists are intersected and united as each query says; and the expression runs
over the remaining candidates' whole texts. A rule without mandatory trigrams
has the query "any" and scans every text. Nothing is shuffled: an index lives
as long as its segment, so memory is bounded by a segment and a lost executor
only repeats its own splits.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadwatch.llm.common import slices

#: Bytes of text per segment (at least one text, whatever its length).
SEGMENT_BYTES = 1 << 20
#: Alternatives kept while strings are spelled out; beyond it a part counts as "any".
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` with ``flags``; matches whose ``group`` is shorter than
    ``least`` are dropped after matching (leftmost, non-overlapping)."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = re.ASCII


# The base kinds, in this order. `{32,}` finds the same spans as
# `+` with a minimum of 32 afterwards, since such runs are maximal.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8,
         re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)

# Published forms of keys and tokens, in this order, after the base
# kinds. Each has mandatory trigrams, so only the index's candidates are read for
# it. Repeats before a separator are bounded, which keeps a match attempt short
# on texts of any length.
KEY_RULES = (
    Rule("private_key", r"-----BEGIN ((RSA|EC|DSA|OPENSSH|ENCRYPTED|PGP) )?PRIVATE KEY( BLOCK)?-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[prs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("pypi", r"pypi-[A-Za-z0-9_-]{16,}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{16,64}\.[A-Za-z0-9_-]{16,64}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,500}\.eyJ[A-Za-z0-9_-]{8,900}\.[A-Za-z0-9_-]{8,}"),
    Rule("url", r"(postgres|postgresql|mysql|mongodb|mongodb\+srv|redis|amqp|amqps|ftp|http|https)://"
                r"[A-Za-z0-9._~%!$&*+,;=-]{1,64}:[A-Za-z0-9._~%!$&*+,;=-]{1,128}@[A-Za-z0-9.-]+"),
)
RULES = BASE_RULES + KEY_RULES

# A query is True (any text), a trigram, or ("and" | "or", frozenset of queries).


def _all(parts):
    flat = set()
    for p in parts:
        if p is not True:
            flat |= p[1] if isinstance(p, tuple) and p[0] == "and" else {p}
    return True if not flat else next(iter(flat)) if len(flat) == 1 else ("and", frozenset(flat))


def _any(parts):
    parts = set(parts)
    return True if True in parts or not parts else next(iter(parts)) if len(parts) == 1 else ("or", frozenset(parts))


def _spelled(s: str):
    return _all(s[i:i + 3] for i in range(len(s) - 2))


def _walk(items):
    """Queries of a parsed expression: the pieces that can be spelled out are kept as
    sets of strings and joined with their neighbours, so trigrams span them."""
    found, exact = [], {""}

    def close():
        nonlocal exact
        found.append(_any(_spelled(s) for s in exact))
        exact = {""}

    def extend(strings):
        nonlocal exact
        joined = {a + b for a, b in product(exact, strings)}
        if len(joined) > MOST_STRINGS:
            close()
            joined = set(strings)
        exact = joined

    for op, arg in items:
        inner, strings = True, None
        if op is C.LITERAL:
            strings = {chr(arg).lower()}
        elif op is C.IN and all(o is C.LITERAL for o, _ in arg):
            strings = {chr(a).lower() for _, a in arg}
        elif op is C.SUBPATTERN:
            if not arg[1]:  # a group that sets flags of its own counts as "any"
                inner, strings = _walk(arg[3])
        elif op is C.BRANCH:
            branches = [_walk(b) for b in arg[1]]
            inner = _any(q for q, _ in branches)
            strings = None if any(s is None for _, s in branches) else set().union(*(s for _, s in branches))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            low, high, what = arg
            q, s = _walk(what)
            if low == 0 and high == 1 and s is not None:
                strings = s | {""}
            elif low >= 1:
                inner = q
                if s is not None and low == high == 1:
                    strings = s
        elif op is C.ATOMIC_GROUP:
            inner, strings = _walk(arg)
        elif op in (C.AT, C.ASSERT, C.ASSERT_NOT):
            strings = {""}
        if strings is not None and len(strings) <= MOST_STRINGS:
            extend(strings)
        else:
            close()
            found.append(inner)
    whole = exact if not found else None
    tail = _any(_spelled(s) for s in exact)
    return _all([*found, tail]), whole


def trigram_query(pattern: str, flags: int = 0):
    """Boolean query over lower-cased ASCII trigrams that every match satisfies; ``True``
    if the expression has no mandatory trigram, spells non-ASCII characters, or ignores
    case beyond ASCII (there "s" also matches U+017F)."""
    parsed = _parser.parse(pattern, flags)
    if parsed.state.flags & re.IGNORECASE and not parsed.state.flags & re.ASCII:
        return True
    q = _walk(parsed)[0]
    return q if all(t.isascii() for t in trigrams(q)) else True


def trigrams(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _code(t: str) -> int:
    a, b, c = t.encode()
    return a << 16 | b << 8 | c


class Segment:
    """Inverted index of a block of texts for a vocabulary of trigrams."""

    def __init__(self, texts: list[bytes], slots: np.ndarray, size: int):
        buf = np.frombuffer(b"\x00".join(texts).lower(), np.uint8).astype(np.uint32)
        code = buf[:-2] << 16 | buf[1:-1] << 8 | buf[2:]
        slot = slots[code]
        at = np.flatnonzero(slot)
        ends = np.cumsum([len(t) + 1 for t in texts])
        pairs = np.unique(slot[at].astype(np.int64) << 32 | np.searchsorted(ends, at, "right"))
        bounds = np.searchsorted(pairs >> 32, np.arange(1, size + 2))
        self.postings = [(pairs[a:b] & 0xFFFFFFFF) for a, b in zip(bounds[:-1], bounds[1:])]
        self.all = np.arange(len(texts))

    def search(self, query, number: dict[str, int]) -> np.ndarray:
        """Sorted texts that satisfy ``query``; the shortest lists are intersected first."""
        if query is True:
            return self.all
        if isinstance(query, str):
            return self.postings[number[query]]
        lists = sorted((self.search(q, number) for q in query[1]), key=len)
        out = lists[0]
        for x in lists[1:]:
            out = np.intersect1d(out, x, assume_unique=True) if query[0] == "and" else np.union1d(out, x)
        return out


class Scanner:
    def __init__(self, rules):
        self.rules = [(r, re.compile(r.pattern, r.flags), trigram_query(r.pattern, r.flags)) for r in rules]
        self.number = {t: i for i, t in enumerate(sorted(set().union(*(trigrams(q) for _, _, q in self.rules))))}
        self.slots = np.zeros(1 << 24, np.uint16)
        for t, i in self.number.items():
            self.slots[_code(t)] = i + 1

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Per text its ``(start, rule number, end)``, sorted; positions in code points."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        index = Segment(texts, self.slots, len(self.number)) if self.number and sum(map(len, texts)) > 2 else None
        decoded: dict[int, str] = {}
        for k, (rule, regex, query) in enumerate(self.rules):
            for i in (index.search(query, self.number) if index else range(len(texts))):
                if (s := decoded.get(i)) is None:
                    s = decoded[i] = texts[i].decode()
                for m in regex.finditer(s):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out[i].append((m.start(), k, m.end()))
        for x in out:
            x.sort()
        return out


SPANS = "array<struct<kind:string,start:int,end:int>>"


def with_secrets(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, rules=RULES,
                 redact: bool = False) -> DataFrame:
    """``keep`` columns (default: all) of every row, with ``spans``: each match's kind,
    start and end (code points, end exclusive) by start, then rule order.

    NULL and empty texts have none (``spans`` is never NULL). ``redact=True``
    also replaces each span in ``text_col`` by ``[kind]`` (overlapping spans
    are merged under the first one's kind); a NULL text stays NULL. A column
    of the name ``spans`` in ``docs`` is replaced. Rows are neither dropped
    nor merged, repeated ones included.
    """
    keep = [c for c in (keep or docs.columns) if c != "spans"]
    if redact and text_col not in keep:
        keep.append(text_col)
    cols = [*keep, *([] if text_col in keep else [text_col])]
    at = cols.index(text_col)
    kinds = [r.kind for r in rules]
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def blocks(texts):
        i = 0
        while i < len(texts):
            j, n = i, 0
            while j < len(texts) and (j == i or n + len(texts[j]) <= SEGMENT_BYTES):
                n += len(texts[j])
                j += 1
            yield texts[i:j]
            i = j

    def run(batches):
        scanner = Scanner(rules)
        for b in slices(batches):
            raw = b.column(at).cast(pa.binary()).to_pylist()
            found = [s for block in blocks([t or b"" for t in raw]) for s in scanner.scan(block)]
            arrays = [b.column(i) for i in range(len(keep))]
            if redact:
                arrays[at] = pa.array([None if t is None else redacted(t.decode(), s, kinds) if s else t.decode()
                                       for t, s in zip(raw, found)], pa.string())
            arrays.append(pa.array([[{"kind": kinds[k], "start": s, "end": e} for s, k, e in x] for x in found], span))
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "spans"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*cols).mapInArrow(run, f"{schema}, spans {SPANS}")


def redacted(text: str, spans: list[tuple[int, int, int]], kinds: list[str]) -> str:
    out, at, upto = [], 0, -1
    for start, k, end in spans:
        if start >= upto:
            out += [text[at:start], f"[{kinds[k]}]"]
        upto = at = max(end, upto)
    return "".join([*out, text[at:]])


