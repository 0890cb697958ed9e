"""The splitter against a piece-by-piece statement of its rule."""

import random

import pytest

from marginalia.operators.splitter import ChunkConfig, chunk_spans, located, split_documents


def pieces(text, separator):
    bits = text.split(separator)
    return [p for p in [bits[0]] + [separator + b for b in bits[1:]] if p]


def packed(parts, size, overlap):
    out, buffer, total = [], [], 0
    for part in parts:
        if total + len(part) > size and buffer:
            out.append("".join(buffer).strip())
            while total > overlap or (total + len(part) > size and total > 0):
                total -= len(buffer.pop(0))
        buffer.append(part)
        total += len(part)
    out.append("".join(buffer).strip())
    return [c for c in out if c]


def by_pieces(text, separators, size, overlap):
    separator, rest = separators[-1], []
    for i, s in enumerate(separators):
        if s in text:
            separator, rest = s, separators[i + 1 :]
            break
    out, good = [], []
    for piece in pieces(text, separator):
        if len(piece) < size:
            good.append(piece)
            continue
        out += packed(good, size, overlap) if good else []
        good = []
        out += by_pieces(piece, rest, size, overlap) if rest else [piece]
    return out + (packed(good, size, overlap) if good else [])


def texts_of(text, config):
    return [text[a:b] for a, b in chunk_spans(text, config)]


def test_equals_statement_of_rule_on_random_texts():
    rng = random.Random(3)
    for _ in range(4000):
        parts = [rng.choice(["ab", "é", " ", "\n", "\n\n", "x" * rng.randint(1, 15)]) for _ in range(rng.randint(0, 60))]
        text = "".join(parts)
        size = rng.randint(2, 30)
        config = ChunkConfig(size, rng.randint(0, size - 1))
        want = by_pieces(text, config.separators, size, config.overlap) or [text]
        assert texts_of(text, config) == want


def test_whole_documents_equal_statement_of_rule(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    found = {}
    for row in split_documents(docs.repartition(5)).orderBy("doc_id", "chunk_index").collect():
        found.setdefault(row["doc_id"], []).append(row["text"])
    for row in docs.collect():
        want = by_pieces(row["text"], ("\n\n", "\n", " "), 1200, 150) or [row["text"]]
        assert found[row["doc_id"]] == want


def test_markdown_sections_share_text_between_neighbours():
    section = "# Title\n\n" + "word " * 80 + "\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n```\ncode\n```\n\n"
    for size, overlap in ((1200, 150), (300, 50), (250, 40)):
        chunks = texts_of(section * 4, ChunkConfig(size, overlap))
        assert all(len(c) <= size for c in chunks)
        assert chunks == texts_of(section * 4, ChunkConfig(size, overlap))
    assert len(texts_of(section * 4, ChunkConfig(250, 40))) > len(texts_of(section * 4, ChunkConfig(1200, 150)))


def test_long_token_stays_whole():
    text = "a " + "x" * 50 + " b"
    assert any(len(c) > 10 for c in texts_of(text, ChunkConfig(10, 2)))


def test_positions_are_monotonic_and_exact():
    text = ("same line\n" * 40 + "\n") * 3
    config = ChunkConfig(60, 20)
    places = located(text, chunk_spans(text, config), config.overlap)
    assert [s for s, _ in places] == sorted(s for s, _ in places)
    assert [text[s:e] for s, e in places] == texts_of(text, config)


def test_empty_text_is_one_empty_chunk():
    assert chunk_spans("", ChunkConfig()) == [(0, 0)]


@pytest.mark.parametrize("kwargs", [{"size": 0}, {"overlap": -1}, {"size": 10, "overlap": 10}, {"separators": ()}, {"separators": (1,)}])
def test_bad_configuration(kwargs):
    with pytest.raises(ValueError):
        ChunkConfig(**kwargs)
