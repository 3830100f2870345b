import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from metricloom.llm import bpe, token_files
from metricloom.llm.queries import VOCABULARY
from tests.llm.conftest import clashing


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def automaton():
    return bpe.load_automaton(VOCABULARY)


LETTERS = "abcdeinothrsl'’.,!?0129<|>_- \t\n\r\x1c\x85 ABÉİΣςßñ中文🙂é"


@given(st.one_of(st.text(LETTERS, max_size=60), st.text("aehn", max_size=40), st.text(max_size=30)))
@settings(max_examples=500, deadline=None)
def test_automaton_agrees_with_the_library(library, automaton, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert automaton.encode(text) == ids
    assert automaton.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "haha" * 40, "!" * 90, "I'LL don't 'S", "ａｂ ǅ ½"])
def test_special_cases(library, automaton, text):
    assert automaton.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_tables_stay_in_bounds(library, automaton):
    small = bpe.load_automaton(VOCABULARY)
    small.kept = 5
    text = " ".join(f"word{i} other" for i in range(50))
    for _ in range(3):
        assert small.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert len(small.chunks) <= 5 and len(small.words) <= 6


def test_words_come_back(automaton):
    assert list(bpe.words_of(automaton.encode("Grüße an   alle"), automaton.labels)) == ["grüße", "an", "alle"]


def expected_files(library, rows):
    order = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    return [[*library.encode(r.text or "", add_special_tokens=False).ids, 1] for r in order]


def test_encoding_of_awkward_rows(spark, awkward, library):
    for docs in (awkward, clashing(awkward), awkward.where("false")):
        rows = docs.collect()
        out = bpe.encode_and_decode(docs, VOCABULARY).collect()
        assert sorted(r.n_tokens for r in out) == sorted(len(library.encode(r.text or "", add_special_tokens=False).ids) for r in rows)
        ids = bpe.encode_documents(docs, VOCABULARY).collect()
        assert sorted(list(r.ids) for r in ids) == sorted(library.encode(r.text or "", add_special_tokens=False).ids for r in rows)


def test_files_of_awkward_rows(spark, awkward, library):
    for docs in (awkward, clashing(awkward)):
        out = sorted(token_files.token_files(docs, VOCABULARY).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in out] == [None, None, 1, 2, 3, 5, 5, 7, 8, 9]
        assert [r.start for r in out] == [0, *np.cumsum([r.n_tokens for r in out])[:-1].tolist()]
        ids = expected_files(library, docs.collect())
        assert sorted(r.ids_crc32 for r in out) == sorted(zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids)
    assert token_files.token_files(awkward.where("false"), VOCABULARY).count() == 0


def written(documents):
    stream = io.BytesIO()
    writer = token_files.FileWriter(stream)
    for doc_id, ids in documents:
        writer.add(doc_id, np.array(ids, "<u4").tobytes())
    writer.close()
    return stream.getvalue()


def test_reader_decompresses_only_what_is_asked_for(monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_TOKENS", 8)
    documents = [(i, list(range(i % 5 * 3))) for i in range(40)]
    reader = token_files.FileReader(pa.BufferReader(written(documents)))
    read = []
    frame = reader.frame
    monkeypatch.setattr(reader, "frame", lambda n: read.append(n) or frame(n))
    assert [np.frombuffer(b, "<u4").tolist() for b in reader.ids([3, 4, 30])] == [documents[i][1] for i in (3, 4, 30)]
    assert len(read) <= 3 < len(reader.entries) - 1
    assert [np.frombuffer(b, "<u4").tolist() for b in reader.ids(range(40))] == [d[1] for d in documents]


def test_file_is_ordinary_zstandard_and_checksums_count():
    data = written([(1, [1, 2, 3]), (2, [4])])
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert np.frombuffer(plain, "<u4").tolist() == [1, 2, 3, 4]
    entry = data.rindex(token_files.checksum(plain).to_bytes(4, "little"))
    broken = data[:entry] + bytes([data[entry] ^ 1]) + data[entry + 1 :]
    with pytest.raises(ValueError, match="checksum"):
        list(token_files.FileReader(pa.BufferReader(broken)).ids([0]))
