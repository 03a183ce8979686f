"""Operators 2 and 3 against the libraries they must equal."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import pieces, token_files
from tallyhouse.llm.queries import QUERIES
from tallyhouse.llm.workers import find_package

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = " \n\t▁ab0<>|sé́\x00漢😀ſßİΣ \x85\x1c　'tre.,J̌"
ROWS = [(3, "Some words, here."), (1, None), (2, ""), (3, "Some words, here."), (None, "x  y "), (7, "ab " * 30_000), (5, "a<|endoftext|>b 0 01")]


def strings(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 16))) for _ in range(n)]


@pytest.fixture(scope="module")
def codec():
    return pieces.PieceCodec(MODEL)


def test_pieces_equal_the_library(codec):
    for s in strings(3000):
        ids = codec.encode(s)
        assert ids.tolist() == codec.agenda.library.encode(s), repr(s)
    codec.check()


def test_list_and_heap_agendas_agree(codec):
    long = "▁" + "".join(random.Random(2).choice("therinandou") for _ in range(300))
    assert codec.agenda.merged(long) == codec.agenda.library.encode(long[1:], out_type=str)


def test_memory_bound_changes_nothing():
    small = pieces.PieceCodec(MODEL, memory=3)
    for s in ("the cat sat", "on the mat, the cat", "cat cat"):
        assert small.encode(s).tolist() == small.agenda.library.encode(s)
        small.check()
    assert len(small.spaced) <= 6


def test_piece_frame(spark, table):
    find_package(spark)
    docs = table([(*r, "clash") for r in ROWS], "doc_id long, text string, ids string")
    out = pieces.encode_texts(docs, MODEL).collect()
    lib = pieces.PieceCodec(MODEL).agenda.library
    assert sorted((r.doc_id or 0, r.text or "", r.ids, r.decoded) for r in out) == sorted(
        (i or 0, t or "", lib.encode(t or ""), lib.decode(lib.encode(t or ""))) for i, t in ROWS
    )
    assert pieces.encode_texts(docs.limit(0), MODEL).count() == 0


def test_piece_query(spark, sf_dir):
    lib = pieces.PieceCodec(MODEL).agenda.library
    wanted = {}
    for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist():
        ids = lib.encode(r["text"] or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        wanted[r["doc_id"]] = (len(ids), digest, hashlib.sha256(lib.decode(ids).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op2_sentencepiece"](spark, sf_dir).collect()}
    assert got == wanted


def test_words_equal_the_library():
    coder, lib = token_files.WordCoder(WORDS), Tokenizer.from_file(WORDS)
    texts = [s + t for s in strings(1500, 3) for t in ("", "<|endoftext|>")]
    for s, packed in zip(texts, coder.encode([s.encode() for s in texts], 2), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == [*lib.encode(s, add_special_tokens=False).ids, 2], repr(s)


def test_letters_and_tails_equal_the_library():
    coder, lib = token_files.WordCoder(WORDS), Tokenizer.from_file(WORDS)
    r, odd = random.Random(4), "aÀéßÿµª×÷Ÿ'srel\u0301ΣſKİ.,!*$-_\"~^0 "
    texts = ["".join(r.choice(odd) for _ in range(r.randint(1, 9))) for _ in range(4000)]
    for s, packed in zip(texts, coder.encode([s.encode() for s in texts], 2), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == [*lib.encode(s, add_special_tokens=False).ids, 2], repr(s)


def test_words_that_differ_in_case_or_tail_are_asked_once():
    coder = token_files.WordCoder(WORDS)
    coder.encode(["Élève*** élève!! ÉLÈVE (élève".encode(), "ÉLÈVE*** word!! WORD***".encode()], 2)
    assert sorted(coder.codes) == sorted(["", "élève", "(élève", "word", "***", "!!"])


@pytest.mark.parametrize("top", [1, 3, 300, 70_000, 1 << 32])
def test_codes_give_every_id_back(top):
    values = np.random.default_rng(0).integers(0, top, 3000).astype(np.uint32)
    codes = token_files.DirectCodes.from_bytes(token_files.DirectCodes.build(values).to_bytes())
    assert (codes.all() == values).all() and len(codes) == 3000
    assert [codes[i] for i in range(0, 3000, 13)] == values[::13].tolist()


def test_codes_of_nothing_and_of_other_files():
    assert len(token_files.DirectCodes.from_bytes(token_files.DirectCodes.build(np.zeros(0)).to_bytes()).all()) == 0
    with pytest.raises(ValueError):
        token_files.DirectCodes.from_bytes(b"PAR1....")


def test_token_files(spark, table, monkeypatch):
    find_package(spark)
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 10)
    docs = table([(*r, "clash") for r in ROWS], "doc_id long, text string, part string")
    out = token_files.token_file_digests(docs, WORDS).collect()
    lib = Tokenizer.from_file(WORDS)
    ids = {t: [*lib.encode(t or "", add_special_tokens=False).ids, 2] for _, t in ROWS}
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    start, wanted = 0, []
    for i, t in ordered:
        wanted.append((i or 0, start, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())))
        start += len(ids[t])
    assert sorted((r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in out) == sorted(wanted)
    assert token_files.token_file_digests(docs.limit(0), WORDS).count() == 0


def test_token_query(spark, sf_dir):
    lib, start, wanted = Tokenizer.from_file(WORDS), 0, {}
    for r in sorted(pq.read_table(f"{sf_dir}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"]):
        ids = np.array([*lib.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        wanted[r["doc_id"]] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op3_token_files"](spark, sf_dir).collect()}
    assert got == wanted
