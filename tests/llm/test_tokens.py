import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marginalia.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=300))
def test_code_round_trip(ids):
    values = np.array(ids, np.uint64)
    words, offsets, escapes = tokens.packed(values)
    assert tokens.unpacked(words, offsets, escapes, len(values)).tolist() == ids


def test_long_round_trip_and_size():
    ids = np.random.default_rng(1).integers(0, 128, 50_000).astype(np.uint64)
    words, offsets, escapes = tokens.packed(ids)
    assert (tokens.unpacked(words, offsets, escapes, len(ids)) == ids).all()
    assert len(words) == -(-4096 // 8) * 12 + -(-(50_000 - 12 * 4096) // 8) and len(escapes) == 0
    # One block alone, by its offset.
    block = words[offsets[3] : offsets[4]]
    assert (tokens.unpacked(block, np.array([0, len(block)]), escapes, 4096) == ids[3 * 4096 : 4 * 4096]).all()


def test_segments():
    raw = tokens.segment([5, 6], [2, 0], np.array([1, 2], np.uint32)) + tokens.segment([7], [1], np.array([9], np.uint32))
    got = [(d.tolist(), n.tolist(), ids.tolist()) for d, n, ids in tokens.segments(io.BytesIO(raw))]
    assert got == [([5, 6], [2, 0], [1, 2]), ([7], [1], [9])]
    with pytest.raises(ValueError):
        list(tokens.segments(io.BytesIO(b"x" * 100)))


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(PATH)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("ab \n\t'1.é\xa0　 日😀"), max_size=30), max_size=5))
def test_pieces_do_not_change_the_ids(encoder, texts):
    raw = [t.encode() for t in texts]
    ids, sizes = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw], dtype=np.int64))
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "IDS_KEPT", 5)
    one = tokens.Encoder(PATH)
    for text in ("some words here", "other words there", "some words here"):
        raw = np.frombuffer(text.encode(), np.uint8)
        assert one.encode(raw, np.array([len(raw)]))[0].tolist() == one.tokenizer.encode(text, add_special_tokens=False).ids


def test_remembered_pieces_are_small():
    one = tokens.Encoder(PATH)
    for first in range(0, 60_000, 20_000):
        text = " ".join(f"x{i}" for i in range(first, first + 20_000))
        raw = np.frombuffer(text.encode(), np.uint8)
        want = one.tokenizer.encode(text, add_special_tokens=False).ids
        assert one.encode(raw, np.array([len(raw)]))[0].tolist() == want
    # Arrays only, without an object per piece: a mark, a number, a place and its ids, with room to double.
    held = [x for x in vars(one).values() if isinstance(x, np.ndarray)]
    assert not any(isinstance(x, (dict, list)) for x in vars(one).values())
    assert sum(x.nbytes for x in held) < 60_000 * 80


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files(frame, monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT_IDS", 50)
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(-5, 60)] + [(None, "first"), (70, None), (71, ""), (72, "word " * 5000)]
    df = frame([(*r, "x", 1) for r in rows], "doc_id long, text string, path string, part long")
    got = sorted(map(tuple, tokens.read_ids(tokens.write_ids(df, PATH)).collect()), key=lambda r: r[1])
    assert got == expected(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))


def test_repeated_and_empty(frame, spark):
    df = frame([(1, "same"), (1, "same"), (2, "x")], "doc_id long, text string")
    got = sorted(map(tuple, tokens.read_ids(tokens.write_ids(df, PATH)).collect()))
    assert got == expected([(1, "same"), (1, "same"), (2, "x")])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.read_ids(tokens.write_ids(empty, PATH)).count() == 0


def test_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, tokens.read_ids(tokens.write_ids(docs, PATH)).collect()))
    assert got == expected(sorted(map(tuple, docs.collect())))
