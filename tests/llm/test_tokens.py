import re
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadwatch.llm import token_counts as TC
from roadwatch.llm import token_output as TO
from roadwatch.llm import tokens as T

ODD = ["It's <|endoftext|> X", "ǅ ß İstanbul", "á b", "H̱x", "x\x1cy\x85z\xa0w", "don't WE'LL 12²³ ¿Qué? «où» naïve—œuvre… 'st", " a'sb",
       "漢字 テスト 3٣", "ΑΣ ΑΣ.", "K ſ", "", " \n", "ŉ ŀ ĸ Ĳ ǆ µ º ª", "\xad­soft", "´a ¨b ¸c ¯d", "“q” ‘r’ • – ‰", "Enözuver ungßlich STRASSE",
       "a  b", "a \n b", "\n\nW", " lead", " trail ", "a\n\n\nb  ", "x\t\ty", "a  \n\nb", "a　 b", "it's  we'll", "\x1c \x1d a", "a b\nc  ", "<|"]
WORD = T.WordEncoder(T.tokenizer_path(T.WORD_BPE))
BYTE = T.ByteSpans(T.tokenizer_path(T.BYTE_BPE), T.byte_pattern())


def same(text):
    assert WORD.encode(text) == np.array(WORD.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert BYTE.lengths(text.encode()).tolist() == BYTE.length[BYTE.encoding.encode_ordinary(text)].tolist()


def test_odd_texts_encode_as_the_libraries_do():
    for t in ODD + [" ".join(ODD)]:
        same(t)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'.,sStTrRvelLmdD09ßÀé×<|… \x1ć"), st.characters(codec="utf-8")), max_size=30))
def test_any_text_encodes_as_the_libraries_do(text):
    same(text)


def by_library(texts):
    return [WORD.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_batch_looks_each_distinct_word_up_once(monkeypatch):
    looked = []

    class Counted(T.Memory):
        def __getitem__(self, piece):
            looked.append(piece)
            return super().__getitem__(piece)

    encoder = T.WordEncoder(T.tokenizer_path(T.WORD_BPE))
    monkeypatch.setattr(encoder, "memory", Counted(encoder._piece))
    texts = ["The cat, the dog\nand THE cat: naïve dog"] * 500
    assert [x.tolist() for x in encoder.encode_all(pa.array(texts))] == by_library(texts)
    # the cat , the dog and cat : naïve, and the end of each of the 7 distinct words
    assert len([p for p in looked if p != "\n"]) <= 9 and len(looked) <= 16


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(alphabet=" \n\t'.,sStTéÀ<|漢D0", max_size=12)), min_size=1, max_size=8))
def test_batches_encode_as_the_library_does(texts):
    padded = pa.array(["dropped", *texts])
    assert [x.tolist() for x in WORD.encode_all(padded.slice(1))] == by_library(texts)


def test_long_pieces_are_not_kept():
    encoder = T.WordEncoder(T.tokenizer_path(T.WORD_BPE))
    text = "x" * (T.LONGEST + 1) + " word " + "y" * T.LONGEST
    assert [encoder.encode_all(pa.array([text]))[0].tolist()] == by_library([text])
    assert set(encoder.memory) == {"word", "y" * T.LONGEST, "\n"}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=30), st.integers(1, 60))
def test_slices_by_size_hold_every_row_once(texts, size):
    b = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["id", "text"])
    cut = [s.column(1).to_pylist() for s in TO.sized([b], size)]
    assert [t for s in cut for t in s] == texts
    assert all(s and sum(len((t or "").encode()) for t in s[1:]) < size for s in cut)


def test_memory_forgets_but_stays_right(monkeypatch):
    monkeypatch.setattr(T, "GENERATION", 3)
    m = T.Memory(lambda p: p.upper())
    assert [m[x] for x in "abcdeabcdefa"] == list("ABCDEABCDEFA") and len(m) <= 3 and len(m.old) <= 3


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2 ** 32 - 1)), min_size=1, max_size=300))
def test_pack_round_trip(ids):
    a = np.array(ids, np.uint32)
    assert (TO.unpack(TO.pack(a)) == a).all()


ROWS = [(5, "Hello world", 1), (None, "no id", 2), (3, None, 3), (4, "", 4), (5, "hello again world", 5), (5, "Hello world", 1),
        (2 ** 40, "x" * 5 + " long text" * 60_000, 6), (-7, "été 123", 7)]
SCHEMA = "doc_id long, text string, ids_crc32 long"


def test_files_read_back(spark):
    got = [tuple(r) for r in TO.token_files(spark.createDataFrame(ROWS, SCHEMA)).collect()]
    ids = {t: WORD.tokenizer.encode(t or "", add_special_tokens=False).ids + [TO.END_ID] for _, t, _ in ROWS}
    want = sorted((str(d), len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for d, t, _ in ROWS)
    assert sorted((str(d), n, c) for d, _, n, c in got) == want
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[1] for r in by_start] == [0, *np.cumsum([r[2] for r in by_start])[:-1].tolist()]
    assert [r[0] for r in by_start] == sorted((d for d, _, _ in ROWS), key=lambda d: (d is not None, d or 0))
    assert TO.token_files(spark.createDataFrame([], SCHEMA)).count() == 0


def test_random_access(spark):
    path = tempfile.mkdtemp() + "/t"
    TO.write_tokens(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), "file://" + path)
    whole = np.array([], np.uint32)
    for f in sorted(pafs.LocalFileSystem().get_file_info(pafs.FileSelector(path)), key=lambda f: f.path):
        with pafs.LocalFileSystem().open_input_file(f.path) as g:
            r = TO.Reader(g, f.size)
            whole = np.concatenate([ids for _, ids in r.documents()])
            for a, b in [(0, 3), (4095, 4097), (r.n - 1, r.n), (0, r.n), (5, 5)]:
                if b <= r.n:
                    assert (r.ids(a, b) == whole[a:b]).all()


def brute_counts(text):
    ids = BYTE.encoding.encode_ordinary(text)
    owner, bounds = [], [0]
    line_of, line = [], 0
    for byte in text.encode():
        line_of.append(line)
        line += byte == 10
    out = {}
    at = 0
    for i in ids:
        n = int(BYTE.length[i])
        held = line_of[at:at + n]
        best = max(sorted(set(held)), key=held.count)
        a, b = out.get(best, (0, 0))
        out[best] = (a + 1, b + (len(set(held)) > 1))
        at += n
    return out


@pytest.mark.parametrize("text", [t for t in ODD if t] + ["one\ntwo three\n\nfour", "a\n\n\n\n\nb\n", "é\nü x\n"])
def test_line_counts_against_brute_force(spark, text):
    starts, ends = TC.lines(np.frombuffer(text.encode(), np.uint8))
    long = BYTE.lengths(text.encode()).astype(int)
    z = np.cumsum(long)
    owner, crossing = TC.attribute(z - long, z, starts, ends)
    got = {int(s): (int((owner == s).sum()), int((crossing & (owner == s)).sum())) for s in set(owner.tolist())}
    assert got == brute_counts(text)


def test_token_counts_rows(spark):
    rows = [(1, "one two\nthree\n", "T"), (2, None, "T"), (None, "é\nü", None), (1, "one two\nthree\n", "T")]
    df = spark.createDataFrame(rows, "doc_id long, text string, section string")
    got = sorted(((r.doc_id, r.section, r.start, r.end, r.n_tokens) for r in TC.token_counts(df).collect()), key=str)
    want = []
    for doc, text, _ in rows:
        counts, at = brute_counts(text) if text else {}, 0
        for k, line in enumerate(re.findall(r"[^\n]*\n|[^\n]+", text or "") or [""]):
            want.append((doc, k, at, at + len(line), counts.get(k, (0, 0))[0]))
            at += len(line)
    assert got == sorted(want, key=str)
    assert TC.token_counts(df.limit(0)).count() == 0
    two = TC.token_counts(df, text_cols=["section", "text"], separator="").collect()
    assert {r.name for r in two} == {"section", "text"}
    r1 = [r for r in two if r.doc_id == 1][:2]
    assert sum(r.n_tokens for r in r1) == len(BYTE.encoding.encode_ordinary("Tone two\nthree\n"))
