import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import ODD, documents, words
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tallyloom.llm import records, tokens

PATHS = {name: public_tokenizers.path(f"{name}.json") for name in ("word_bpe_49k", "byte_bpe_50k")}
LIBRARIES = {name: Tokenizer.from_file(path) for name, path in PATHS.items()}
IDS = {name: tokens.Ids(path) for name, path in PATHS.items()}
WORD = PATHS["word_bpe_49k"]
LONG = [" " * 2_000_000, "\n" * 500_000 + "x", "　" * 500_000 + "end", "word " * 3 + " \n\t" * 300_000, "a" * 1_000_000, "lorem ipsum, " * 80_000]


def library(name, text):
    return LIBRARIES[name].encode(text or "", add_special_tokens=False).ids


def ids(name, texts):
    flat, offsets = IDS[name].encode(pa.array(texts, pa.string()))
    return [part.tolist() for part in np.split(flat, offsets[1:-1])] if texts else []


@pytest.mark.parametrize("name", PATHS)
@settings(max_examples=500, deadline=None)
@given(texts=st.lists(st.one_of(
    st.text(max_size=60), st.text(alphabet="abceSTΣςσİßéȨ́́'’.,!-12²½<|>\n\t\r\x0b\x1c\x85\xa0　 ", max_size=60),
    st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "It's", "WE'LL", "a", " ", "\n", "Ünï", "'", "don't.", "3½", "ΌΔΟΣ"]), max_size=10).map("".join)), max_size=4))
def test_ids_are_the_library_s(name, texts):
    assert ids(name, texts) == [library(name, t) for t in texts]


@pytest.mark.parametrize("name", PATHS)
def test_long_texts(name):
    assert ids(name, LONG) == [library(name, t) for t in LONG]


def test_forgetting(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    monkeypatch.setattr(tokens, "REMEMBERED_LENGTH", 4)
    own = tokens.Ids(WORD)
    for seed in (1, 2, 1):
        text = words(200, seed)
        assert own.encode(pa.array([text]))[0].tolist() == library("word_bpe_49k", text)


def crc32c(data):
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def masked(crc):
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def test_checksums():
    assert crc32c(b"123456789") == 0xE3069283  # the published check value
    sums, r = records.Checksums(), np.random.default_rng(0)
    messages = [r.bytes(4 * n) for n in (1, 2, 3, 255, 256, 257, 1000, 512, 1)] + [b"\0" * 8, b"\0" * 2048]
    assert sums(messages).tolist() == [masked(crc32c(m)) for m in messages]
    assert sums([]).tolist() == []


def test_damage_is_found():
    sums = records.Checksums()
    payload = records.packed(7, b"abcdefgh", 4)
    frame = records.framed([payload], sums)[0]
    assert records.unframed([frame], sums) == [payload]
    for at in range(len(frame)):
        bad = bytearray(frame)
        bad[at] ^= 4
        with pytest.raises(records.BadRecord):
            records.unframed([bytes(bad)], sums)


@pytest.mark.parametrize("doc", [None, 0, -1, 2**63 - 1])
@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_payloads(doc, n):
    ids = np.arange(65_530, 65_530 + n, dtype="<u4").tobytes()
    for kind in ("<u2", "<u4"):
        assert records.unpacked(records.packed(doc, np.frombuffer(ids, "<u4").astype(kind).tobytes(), int(kind[-1]))) == (doc, ids)


def brute(rows):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        found = np.array(library("word_bpe_49k", text) + [2], "<u4")
        out.append((doc, start, len(found), zlib.crc32(found.tobytes())))
        start += len(found)
    return out


def check(rows, got):
    """Equal ids may come in any order among themselves, so their starts are told apart by size alone."""
    want = brute(rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted((d is not None, d or 0, n, c) for d, _, n, c in want)
    ordered = sorted(got, key=lambda r: r.start)
    at = 0
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in ordered] == [d for d, *_ in want]
    once = {d for d, *_ in want if sum(w[0] == d for w in want) == 1}
    assert {(r.doc_id, r.start) for r in got if r.doc_id in once} == {(d, s) for d, s, *_ in want if d in once}


def test_written_and_read_back(spark, tmp_path, monkeypatch):
    rows = ODD + [(-5, "minus"), (2**40, "a<|endoftext|> b  <|startoftext|>"), (30, "A b. " * 200_000)] + [(100 + i, words(i % 50, i)) for i in range(300)]
    path = str(tmp_path / "out")
    index = records.write_records(documents(spark, rows, clash=True).repartition(5), path, WORD)
    assert index.count() == len(rows) and index.columns == [c.split()[0] for c in records.INDEX.split(", ")]
    monkeypatch.setattr(records, "SPLIT", 50_000)
    monkeypatch.setattr(records, "READ", 10_000)
    got = records.read_records(spark, path).collect()
    check(rows, got)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    key = lambda rs: sorted(map(repr, rs))
    shuffled = records.read_records(spark, path, seed=3).collect()
    assert key(shuffled) == key(got) and shuffled != got
    assert shuffled == records.read_records(spark, path, seed=3).collect() != records.read_records(spark, path, seed=4).collect()


def test_files_are_read_by_the_index_alone(spark, tmp_path):
    path = str(tmp_path / "out")
    records.write_records(documents(spark, [(1, "a b"), (2, "c")]), path, WORD)
    (tmp_path / "out" / "part-000000-lost.records").write_bytes(b"left by a lost task")
    assert sorted(r.doc_id for r in records.read_records(spark, path).collect()) == [1, 2]
    named = records.read_index(spark, path).first().name
    data = bytearray((tmp_path / "out" / named).read_bytes())
    data[-6] ^= 1
    (tmp_path / "out" / named).write_bytes(bytes(data))
    with pytest.raises(Exception, match="damaged"):
        records.read_records(spark, path).collect()


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    assert records.write_records(documents(spark, []), path, WORD).count() == 0
    assert records.read_records(spark, path).count() == 0
