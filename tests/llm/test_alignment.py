"""Operator 12 against both libraries on whole texts and a plain count."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyhouse.llm import alignment
from tallyhouse.llm.queries import QUERIES
from tallyhouse.llm.workers import find_package

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIELDS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
ODD = ["the", " ", "  ", "\n", "\n\n", "a", "é", "ö", "x1", "12", ".", ",", "'s", " '", "\t", " ", "日本", "😀", "<|endoftext|>", "<s>", "▁", "\x1c", "don't", "\x00", "Hello", "\r\n", "a b", "́"]


def plainly(texts):
    a_lib, b_lib, alphabet = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), alignment.byte_alphabet()
    a_lib.encode_special_tokens = True
    a_bytes = {i: bytes(alphabet[c] for c in s) for s, i in a_lib.get_vocab(with_added_tokens=False).items()}

    def b_bytes(i):
        piece = b_lib.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(ids, of):
        out, end = [], 0
        for i in ids:
            out.append((end, end + len(of(i)), i))
            end = out[-1][1]
        return out

    per = []
    for text in texts:
        per.append(None)
        if not text:
            continue
        raw, a, b = (" " + text).encode(), a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
        if b"".join(map(a_bytes.get, a)) != raw or b"".join(map(b_bytes, b)) != raw:
            continue
        a, b = spans(a, a_bytes.get), spans(b, b_bytes)
        of_byte = [[n for n, (s, e, _) in enumerate(side) for _ in range(s, e)] for side in (a, b)]
        links = [(a[x][2], b[y][2]) for x, y in dict.fromkeys(zip(*of_byte, strict=True))]
        cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        sides = [{c: [] for c in cuts} for _ in "ab"]
        for side, found in zip((a, b), sides, strict=True):
            for _, e, i in side:
                found[cuts[bisect_left(cuts, e)]].append(str(i))
        groups = ["|".join(",".join(found[c]) for found in sides) for c in cuts]
        per[-1] = (len(a), len(b), groups, links)
    count, highest = Counter(), defaultdict(int)
    for p in per:
        count.update(set(p[3]) if p else ())
    for (i, _), n in count.items():
        highest[i] = max(highest[i], n)
    out = []
    for p in per:
        if p is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            best = sum(count[x] == highest[x[0]] for x in p[3])
            out.append((p[0], p[1], len(p[2]), len(p[3]), best, sum(count[x] for x in p[3]), hashlib.sha256(";".join(p[2]).encode()).hexdigest()))
    return out


def rows(frame):
    return sorted(tuple(r[f] for f in FIELDS) for r in frame.collect())


def test_odd_texts_runs_and_merges(spark, table, monkeypatch):
    """Texts of all kinds, copies, and many small runs that take two levels of merging and several copies of the counts."""
    find_package(spark)
    rng = random.Random(3)
    texts = [None, "", " ", "\n", "  a", "a ", "<unk>", "the the the"] + ["".join(rng.choices(ODD, k=rng.randint(1, 30))) for _ in range(250)]
    texts += ["same old words"] * 200 + [" ".join(rng.choices(["the", "cat's", "naïve", "unbelievable.", "x\ny"], k=40)) for _ in range(60)] + ["ab" * 3000]
    for name, value in (("RUN_RECORDS", 900), ("BATCH_DOCS", 20), ("FAN_IN", 4), ("RUNS_PER_COPY", 4), ("COUNT_ROW", 16)):
        monkeypatch.setattr(alignment, name, value)
    docs = table([(i, "clash", t, 1) for i, t in enumerate(texts)], "doc_id long, n_a string, text string, kind int").repartition(3)
    assert rows(alignment.align_tokens(docs, A, B)) == sorted((i, *p) for i, p in enumerate(plainly(texts)))


def test_memory_that_restarts(spark, table, monkeypatch):
    find_package(spark)
    coder = alignment.Aligner(A, B)
    texts = [f"word{i} other{i % 7}" for i in range(50)]
    whole = coder.batch(texts)
    monkeypatch.setattr(alignment, "MEMORY", 3)
    parts = [coder.batch(texts[k : k + 5]) for k in range(0, 50, 5)]
    assert [d for p in parts for d in p[1]] == whole[1]
    assert sum(p[4].sum() for p in parts) == whole[4].sum()


def test_null_ids_repeats_and_no_rows(spark, table):
    find_package(spark)
    docs = table([(None, "a b"), (None, "a b"), (1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    got = [tuple(r) for r in alignment.align_tokens(docs, A, B).orderBy(*FIELDS).collect()]
    assert len(got) == 5 and all(r[6] == 4 * r[4] for r in got if r[1])
    assert alignment.align_tokens(docs.limit(0), A, B).collect() == []


def test_table_of_pairs(spark, table):
    find_package(spark)
    runs = alignment.spill_runs(table([(1, "a b"), (2, "a c")], "doc_id long, text string"), A, B)
    found = alignment.alignment_table(alignment.pair_counts(runs))
    assert sorted(r.n_docs for r in found.collect()) == [1, 1, 2] and found.filter("best").count() == 3


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((d.doc_id, *p) for d, p in zip(docs, plainly([d.text for d in docs]), strict=True))
    assert rows(QUERIES["op12_token_alignment"](spark, sf_dir)) == want


def test_models_with_pieces_across_words_are_refused(monkeypatch):
    monkeypatch.setattr(alignment, "B_BITS", 3)
    with pytest.raises(ValueError):
        alignment.Aligner(A, B)
