"""Operators 5 and 8 against plain Python, and their plans."""

import hashlib
import random
import re

import pyarrow.parquet as pq
import pytest

from tallyhouse.llm import decontamination, personal_data
from tallyhouse.llm.queries import QUERIES


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
}


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in BASE.items() for m in re.finditer(p, text or "") if ok(m[0])]


def expected(rows):
    out = []
    for i, t in rows:
        s = base_spans(t)
        counts = tuple(sum(x.startswith(k) for x in s) for k in BASE)
        out.append((i or 0, *counts, hashlib.sha256(",".join(s).encode()).hexdigest()))
    return sorted(out)


def got(frame):
    return sorted((r.doc_id or 0, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in frame.collect())


def test_base_spans_of_random_texts(spark, table):
    r = random.Random(4)
    parts = ["a@b.c", "@", ".", "1.2.3.4", "256", "4111 1111 1111 1111", "4111-1111", "+1 (846) 555-3472", "+", " ", "é😀", "x_y%z@q-r.s.t_u@v.w", "\u0001", "00001.1.1.1", "\n", "123"]
    rows = [(k, "".join(r.choice(parts) for _ in range(r.randint(0, 12)))) for k in range(600)]
    rows += [(600, None), (601, ""), (3, rows[3][1]), (3, "other a@b.cd"), (None, "a@b.cd"), (602, "a@" + "b." * 20_000 + "c " + "1" * 50_000 + ("+1" * 20_000) + "x" * 50_000)]
    docs = table([(*x, 1) for x in rows], "doc_id long, text string, kind int")
    assert got(personal_data.personal_data(docs)) == expected(rows)


def test_contexts_discover_identifiers(spark, table):
    rows = [(k, f"w{k} words contact: u{k}@mail.org then more") for k in range(12)]
    rows += [(20, "so contact: user12345x then on"), (21, "so other user12345y here on"), (22, "the contact: nobody then")]
    spans = {r.doc_id: r.spans for r in personal_data.personal_data(table(rows, "doc_id long, text string")).collect()}
    assert spans[20] == "id:12:22" and spans[21] == "" and spans[22] == ""
    assert all(spans[k].startswith("email:") and spans[k].count(":") == 2 for k in range(12))


def test_discovered_identifiers_discover_others(spark, table):
    """From addresses to an identifier beside the same word, and from its other places to one that no seed's context touches."""
    rows = [(k, f"w{k} words contact: u{k}@mail.org then{k} more") for k in range(12)]
    rows += [(20, "so contact: AB123456 on"), (40, "so member CD987654 off"), (41, "so nothing EF987654 off")]
    rows += [(k, f"the member AB123456 x{k} here") for k in range(21, 30)]
    spans = {r.doc_id: r.spans for r in personal_data.personal_data(table(rows, "doc_id long, text string")).collect()}
    assert spans[20] == "id:12:20" and spans[21] == "id:11:19" and spans[40] == "id:10:18" and spans[41] == ""


def test_redaction(spark, table):
    rows = [(1, "é mail a@b.cd, ip 1.2.3.4!", 0, "k"), (2, None, 0, "k"), (3, "+12.34.56.78.90 x", 0, "k"), (1, "é mail a@b.cd, ip 1.2.3.4!", 0, "k")]
    docs = table(rows, "doc_id long, text string, n_chars long, blocks string")
    out = personal_data.redact(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars, r.blocks) for r in out.collect() if r.doc_id != 2) == [
        (1, "é mail [email], ip [ip]!", 24, "k"), (1, "é mail [email], ip [ip]!", 24, "k"), (3, "[phone] x", 9, "k"),
    ]
    assert personal_data.personal_data(docs.limit(0)).count() == 0


def test_personal_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    assert got(QUERIES["op5_personal_data"](spark, sf_dir)) == expected(rows)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contaminated(docs, items):
    out = []
    windows = [(i, {tuple(w[k : k + min(10, len(w))]) for k in range(len(w) - min(10, len(w)) + 1)}) for i, t in items if (w := words(t))]
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for i, of_item in windows:
            n = len(next(iter(of_item)))
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in of_item:
                    hit |= set(range(k, k + n))
                    if i is not None:
                        found.add(str(i))
        out.append((doc_id or 0, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def rows_of(frame):
    return sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect())


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_decontamination_equals_every_window(spark, table, monkeypatch, broadcast):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", broadcast)
    r = random.Random(6)
    vocabulary = "the a Of in É été 42 x".split()
    text = lambda n: " ".join(r.choice(vocabulary) + r.choice(["", "", ",", "-B"]) for _ in range(n))
    items = [(k, text(r.choice([12, 15, 25]))) for k in range(8)] + [(8, "rare short, Item"), (9, "q w e r t z u i"), (10, None), (11, "?!"), (8, "second text of it"), (None, "nameless item here")]
    docs = []
    for k in range(120):
        t = text(r.randint(0, 60))
        for _ in range(r.randint(0, 2)):
            piece = words(r.choice(items)[1])
            cut = piece[r.randint(0, 2) : len(piece) - r.randint(0, 2)]
            t = t + " | " + " ".join(cut).upper() + " " + text(r.randint(0, 5))
        docs.append((k, t))
    docs += [(500, None), (501, ""), (3, docs[3][1]), (3, "another"), (None, items[0][1]), (502, (items[1][1] + " ") * 300)]
    frame = table([(*d, 1) for d in docs], "doc_id long, text string, n int").repartition(3)
    bench = table(items, "item_id long, text string")
    assert rows_of(decontamination.contamination(frame, bench)) == contaminated(docs, items)
    dirty = {(i, t) for (i, t), row in zip(docs, [contaminated([d], items)[0] for d in docs], strict=True) if row[-1]}
    kept = sorted((r.doc_id or 0, r.text or "") for r in decontamination.clean_documents(frame, bench).collect())
    assert kept == sorted((i or 0, t or "") for i, t in docs if (i, t) not in dirty)


def test_decontamination_of_nothing(spark, table):
    docs, none = table([(1, "a b c")], "doc_id long, text string"), table([], "item_id long, text string")
    assert rows_of(decontamination.contamination(docs, none)) == contaminated([(1, "a b c")], [])
    assert decontamination.contamination(docs.limit(0), none).count() == 0


@pytest.mark.parametrize("build", [lambda s, d: QUERIES["op5_personal_data"](s, d), lambda s, d: QUERIES["op8_decontamination"](s, d)])
def test_no_python_in_the_plan(spark, sf_dir, build):
    plan = build(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
