"""The pipeline's rows against its stages in plain Python, and stages on odd tables."""

import hashlib

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from llm.test_native import base_spans, contaminated
from llm.test_set_join import brute_force

import corpus_pipeline
from tallyhouse.llm.queries import QUERIES


def redacted(text):
    order = ["email", "ip", "card", "phone"]
    spans = sorted((int(a), order.index(k), int(b), k) for k, a, b in (s.split(":") for s in base_spans(text)))
    out, at, k = [], 0, 0
    while k < len(spans):
        start, _, end, kind = spans[k]
        while k + 1 < len(spans) and spans[k + 1][0] < end:
            k += 1
            end = max(end, spans[k][2])
        out += [text[at:start], f"[{kind}]"]
        at, k = end, k + 1
    return "".join(out) + text[at:]


def test_rows_equal_plain_python(spark, sf_dir):
    documents = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    languages = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op9_language"](spark, sf_dir).collect()}
    docs = [(r["doc_id"], r["text"]) for r in documents if languages[r["doc_id"]][0] != "und" and languages[r["doc_id"]][1] >= 0.3]
    assert len(docs) > 0.9 * len(documents)
    stays = {i for i, n, least in brute_force(docs) if n == 0 or i == least}
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()]
    dirty = {row[0] for row in contaminated([d for d in docs if d[0] in stays], items) if row[-1]}
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    wanted = {}
    for i, text in docs:
        if i in stays - dirty:
            ids = lib.encode(redacted(text))
            wanted[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == wanted and 0 < len(wanted) < len(documents)


@pytest.mark.parametrize("rows", [[], [(1, None, "en", "x", 0, "k"), (2, "", None, None, None, None), (2, "plain words here", "en", "s", 16, "k"), (2, "plain words here", "en", "s", 16, "k")]])
def test_stages_on_odd_tables(spark, table, sf_dir, rows):
    """Empty tables, nulls, repeated rows and a further column named like a helper."""
    docs = table(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() <= len(rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == len(rows)


@pytest.mark.parametrize("lang", [None, "en"])
def test_language_stage_without_languages_to_tell(spark, table, lang):
    """Where no language, or only one, is taught, texts with a letter stay."""
    rows = [(k, f"plain words number {k}", lang) for k in range(8)] + [(20, "12 !", lang), (21, None, lang), (22, "", None), (23, "été", None)]
    docs = table(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.identify_language(spark, docs, "").collect()) == [*range(8), 23]


def test_each_stage_calls_its_operator():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "personal_data", "sentencepiece"]
