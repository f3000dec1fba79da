import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from llm_helpers import TWINS, read
from tokenizers import Tokenizer

from pingloom.llm import pretokens, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    "'s", "'t", "'re", "'ll", " ", "  ", "\n", "\t", " a", "é", "中", "１", "½", "x", "'", "''", " '", "Ré", " ", "　", "!!",
    "?", "'d", "'m", "'ve", "it", "'S", "\x1c", "😀", "́", "<|endoftext|>",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("known", [len(PIECES) - 1, len(PIECES)])
def test_encoder_agrees_with_the_tokenizer(tokenizer, known):
    pick, encoder = random.Random(known), pretokens.Encoder(PATH)
    for _ in range(150):
        texts = ["".join(pick.choice(PIECES[:known]) for _ in range(pick.randint(0, 14))) for _ in range(8)] + [None]
        ids, at = encoder.encode(pa.array(texts, pa.string()))
        for k, text in enumerate(texts):
            assert ids[at[k] : at[k + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_texts_of_equal_polynomials_are_told_apart(tokenizer):
    encoder = pretokens.Encoder(PATH)
    for texts in (TWINS, [" ".join(TWINS), " ".join(reversed(TWINS))]):
        ids, at = encoder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [
            tokenizer.encode(t, add_special_tokens=False).ids for t in texts
        ]


def test_equal_hashes_do_not_mix_up_texts(tokenizer, monkeypatch):
    """Every pre-token gets the same hash; what is remembered is compared and the tokenizer asked."""
    monkeypatch.setattr(pretokens.T, "span_hashes", lambda codes, first, last: np.zeros(len(first), np.uint64))
    encoder = object.__new__(pretokens.Encoder)
    encoder.tokenizer, encoder.special = tokenizer, []
    encoder._forget()
    for text in ("aaa", "bbb", "one two"):
        assert encoder.encode(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_forgets_and_goes_on(tokenizer, monkeypatch):
    monkeypatch.setattr(pretokens, "REMEMBERED", 30)
    encoder = pretokens.Encoder(PATH)
    for k in range(20):
        text = " ".join(f"word{i}" for i in range(k, k + 10))
        assert encoder.encode(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder.hashes) <= 60


def expected(rows, tokenizer):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, out = 0, []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark, sf_dir, odd_documents, tokenizer):
    documents = read(spark, sf_dir, "documents").select("doc_id", "text").unionByName(odd_documents.select("doc_id", "text"))
    found = sorted([tuple(r) for r in token_files.round_trip(documents, PATH).collect()], key=lambda r: r[1])
    assert found == expected([tuple(r) for r in documents.collect()], tokenizer)


def test_files_are_zstandard_and_serve_single_documents(spark, sf_dir, tmp_path, tokenizer):
    documents = read(spark, sf_dir, "documents")
    path = str(tmp_path / "files")
    token_files.write(documents, PATH, path, file_bytes=100_000)
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    found = {r["doc_id"]: np.frombuffer(r["ids"], "<u4") for r in token_files.read(spark, path, [7, 42, 10**9]).collect()}
    assert set(found) == {7, 42}
    assert found[7].tolist() == tokenizer.encode(texts[7], add_special_tokens=False).ids + [0]
    content = sorted((tmp_path / "files").glob("part-*"))[0].read_bytes()
    entries = token_files.read_table(content)
    whole = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
    assert len(whole) == 4 * entries["n_tokens"].sum()
    with pytest.raises(ValueError):
        token_files.read_table(content[:-5])
    offsets = np.concatenate(([0], np.cumsum(entries["stored"]))).astype(np.int64)
    damaged = bytearray(content)
    damaged[offsets[1] - 12] ^= 1
    with pytest.raises((zstandard.ZstdError, ValueError)):
        token_files.read_document(bytes(damaged), entries, offsets, 0)


def test_no_rows_and_extra_columns(odd_documents, empty_documents):
    assert token_files.round_trip(empty_documents, PATH).count() == 0
    assert token_files.round_trip(odd_documents, PATH).count() == odd_documents.count()


def test_another_kind_of_tokenizer_is_refused():
    with pytest.raises(ValueError):
        pretokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
