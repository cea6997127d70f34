"""Byte-level BPE and token files."""

from __future__ import annotations

import gc
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from corpus_helpers import frame, messy_rows
from tokenizers import Tokenizer

from sluiceway.llm import byte_bpe, common, pieces, token_files
from sluiceway.sources import storage


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def encoding():
    return token_files.read_encoding(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def odd_texts(n, alphabet="abcdeéßñ🙂漢字² \n\t\x1c\x85\xa0'lstheTHE!!01٣_", size=80):
    rng = random.Random(7)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, size))) for _ in range(n)]
    return [*texts, "a" * 3000, "ab" * 2000, " " * 999, "", "<|endoftext|>", "x<|endoftext|>y", "th" * 800]


def test_encoder_against_library(vocabulary):
    encoder = byte_bpe.BytePairEncoder(vocabulary)
    library = tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=encoder.ids, special_tokens={})
    for text in odd_texts(1500) + odd_texts(300, "thea"):
        ids = encoder.encode(text)
        assert ids == library.encode_ordinary(text)
        assert encoder.decode(ids).decode() == text


def test_encode_and_decode(spark, vocabulary):
    rows = messy_rows()
    docs = frame(spark, rows, extra=True)
    decoded = byte_bpe.decode(byte_bpe.encode(docs, vocabulary), vocabulary)
    assert sorted(((r["doc_id"], bytes(r["bytes"]).decode()) for r in decoded.collect()), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    whole = byte_bpe.tokenized(docs, vocabulary)
    assert whole.columns == [*docs.columns, "ids", "n_tokens"] and whole.where("n_tokens <> size(ids)").count() == 0
    assert sorted((r["text"] or "") for r in whole.collect()) == sorted(t or "" for _, t in rows)
    assert byte_bpe.round_trip(docs, vocabulary).where("n_tokens = 0").count() == sum(not t for _, t in rows)
    assert byte_bpe.round_trip(frame(spark, []), vocabulary).collect() == []


def test_workers_give_up_an_encoder_that_later_tasks_do_not_use(spark, vocabulary):
    def passed(batches):
        yield from batches

    def counted(batches):
        for _ in batches:
            pass
        yield pa.RecordBatch.from_pydict({"n": [sum(isinstance(x, byte_bpe.BytePairEncoder) for x in gc.get_objects())]})

    def encoders():
        return [row.n for row in common.mapped(spark.range(0, 16, 1, 16), counted, "n long").collect()]

    assert byte_bpe.encode(frame(spark, messy_rows()).repartition(8), vocabulary).count() == len(messy_rows())
    assert max(encoders()) == 1
    common.mapped(spark.range(0, 64, 1, 64), passed, "id long").count()
    assert max(encoders()) == 0


@pytest.mark.parametrize("top", [1, 200, 300, 70_000, 2**32])
@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 4000])
def test_codes(top, n):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    codes = token_files.Codes.from_bytes(token_files.Codes.of(ids).to_bytes())
    assert (codes.all() == ids).all() and len(codes) == n
    assert all(codes[i] == ids[i] for i in range(0, n, 5))
    with pytest.raises(IndexError):
        codes[n]


def test_pieces_against_library(encoding):
    library, encoder = Tokenizer.from_str(encoding.definition), token_files.PieceEncoder(encoding)
    for text in odd_texts(1500):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert encoder.encode(text) == np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("block_bytes", [1, 700, 1 << 25])
@pytest.mark.parametrize("kept", [0, 50, 1_000_000])
def test_whole_texts_against_library(encoding, monkeypatch, block_bytes, kept):
    """Words with white space inside and at their ends, double spaces, nulls, special tokens; whatever is looked up together or kept."""
    monkeypatch.setattr(pieces, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(pieces, "ROWS", 64)
    library, encoder = Tokenizer.from_str(encoding.definition), token_files.PieceEncoder(encoding)
    encoder.table.limit = kept
    marks = ["one\ntwo  three\n four", "one\n\ttwo, 's two's", "\none two\n", " one", "one ", "  ", "\n \n", "\u2003one \u2003two\u2003 one", "🙂one ²one one²"]
    texts = [None, *marks, *odd_texts(400), None, "", *odd_texts(200, "the, .\n '"), *odd_texts(100, " \n\ta")]
    found = [ids.tolist() for ids in encoder.encode_all(pa.array(texts))]
    assert found == [library.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert list(encoder.encode_all(pa.array([], pa.string()))) == []
    assert [ids.tolist() for ids in encoder.encode_all(pa.array(["", *texts[:3]]).slice(1, 2))] == found[:2]


def test_pieces_are_encoded_once_for_all_words_that_hold_them(encoding):
    """Words that differ only in the marks around them, within a slice of texts, across slices and across batches."""
    encoder, asked = token_files.PieceEncoder(encoding), []
    tokenize = encoder.model.tokenize
    encoder.model = type("Model", (), {"tokenize": staticmethod(lambda letters: asked.append(letters) or tokenize(letters))})
    texts = [f"a theory{mark} a (theory{mark} a Theory{mark}" for mark in (",", ".", "!", "?", ";", ",", "!!")] * pieces.ROWS
    for _ in range(3):
        assert sum(len(ids) for ids in encoder.encode_all(pa.array(texts))) > len(texts)
    # The first word of a text is looked up by itself.
    assert len(asked) == len(set(asked)) == 1 + len([" a", " theory", " (", "theory", " Theory", ",", ".", "!", "?", ";", "!!"])


@pytest.mark.parametrize("segment_tokens", [300, 400_000])
def test_file(spark, encoding, segment_tokens):
    rows = messy_rows() + [(100 + i, text) for i, text in enumerate(odd_texts(60))]
    path = storage.scratch_dir(spark, "tokens")
    token_files.write(frame(spark, rows, extra=True), encoding, path, segment_tokens)
    found = sorted(token_files.documents(spark, path).collect(), key=lambda r: r["start"])
    library = Tokenizer.from_str(encoding.definition)
    by_id, stream = {}, []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        by_id.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
    at = 0
    assert [r["doc_id"] for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    for row in found:
        match = next(x for x in by_id[row["doc_id"]] if x[:2] == (row["n_tokens"], row["ids_crc32"]))
        by_id[row["doc_id"]].remove(match)
        assert row["start"] == at
        at += row["n_tokens"]
        stream += match[2]
    for position in (0, 1, at // 2, at - 1):
        assert token_files.token(spark, path, position) == stream[position]
    with pytest.raises(IndexError):
        token_files.token(spark, path, at)


def test_empty_file(spark, encoding):
    path = storage.scratch_dir(spark, "tokens")
    token_files.write(frame(spark, []), encoding, path)
    assert token_files.documents(spark, path).collect() == []
