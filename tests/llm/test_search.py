"""Operators 11 and 13 against brute force, on small trees, blocks and windows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import differences, duck

from tallyhouse.llm import cover_tree, lexical
from tallyhouse.llm.queries import QUERIES, SQL
from tallyhouse.llm.workers import find_package


@pytest.mark.parametrize("name", ["op11_inner_products", "op13_lexical_search"])
def test_query_equals_its_statement(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), duck(sf_dir), SQL[name]) is None


# operator 11


def best_products(rows, every=100, k=10):
    whole = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, v in whole:
        if i % every == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in whole if j != i and len(w) == len(v))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(near[:k], 1)]
    return sorted(out)


def test_products_with_ties_copies_and_odd_rows(spark, table, monkeypatch):
    """Few distinct values make ties; one vector is on a third of the rows; one dimension's sums are beyond doubles."""
    find_package(spark)
    for name, value in (("SHARD_NODES", 60), ("BLOCK_QUERIES", 8), ("LEAF", 4), ("TOGETHER", 16)):
        monkeypatch.setattr(cover_tree, name, value)
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.5, 0.0, 0.25, 2.0]) for _ in range(3)]) for i in range(400)]
    rows += [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(400, 800)]
    rows += [(3000 + i, [1.0, 1.0, 1.0]) for i in range(300)]
    rows += [(i, [1e6 + i, 1e6, -3.0, 0.0]) for i in range(2000, 2020)]
    rows += [(900, None), (1000, []), (1100, [1.0, None, 2.0]), (1200, [math.nan, 1.0, 2.0]), (1300, [math.inf, 1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(100, [0.5, 0.5, 0.5]), (100, [0.5, 0.5, 0.5]), (2100, [7.0, 7.0])]
    frame = table([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<double>, score string").repartition(3)
    assert sorted(tuple(r) for r in cover_tree.inner_product_search(frame).collect()) == best_products(rows)
    assert cover_tree.inner_product_search(frame.limit(0)).collect() == []


@pytest.mark.parametrize("kind", ["uniform", "clustered", "equal"])
def test_tree_covers_and_search_prunes(kind):
    rng = np.random.default_rng(4)
    x = {"uniform": rng.normal(size=(900, 3)), "clustered": rng.normal(size=(9, 16))[rng.integers(9, size=900)] * 4 + rng.normal(size=(900, 16)) / 20, "equal": np.ones((900, 4))}[kind]
    vectors = np.floor(1024 * x).astype(np.int64)
    tree, order = cover_tree.CoverTree.build(vectors)
    assert (tree.integers == vectors[order]).all() and sorted(order) == list(range(900))
    below = [(k, k + 1) for k in range(900)]
    for centres, radii, ends in reversed(tree.levels):
        below = [(below[a][0], below[b - 1][1]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for centre, radius, (a, b) in zip(centres, radii, below, strict=True):
            assert a <= centre < b and np.linalg.norm(tree.vectors[a:b] - tree.vectors[centre], axis=1).max() <= radius + 1e-6
    assert below == [(0, 900)]
    scored = []
    plain = cover_tree.DualSearch._score
    search = cover_tree.DualSearch(tree, tree, order, 10)
    search._score = lambda own, some: (scored.append((own.stop - own.start) * len(some)), plain(search, own, some))
    search.run()
    assert (search.scores == -np.sort(-(tree.integers @ tree.integers.T), axis=1)[:, :10]).all()
    if kind != "equal":
        assert sum(scored) < 0.75 * 900 * 900


# operator 13

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def best_documents(docs, items, k=10):
    counts = [(i, c) for i, t in docs if (c := Counter(terms_of(t)))]
    n_docs, n_words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms_of(text)) if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if lost else i, -s) for rank, (s, lost, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("term_filter", [1000, -1], ids=["lists of asked terms", "lists of all terms"])
def test_ranking_with_ties_copies_and_odd_rows(spark, table, monkeypatch, term_filter):
    find_package(spark)
    small = {"BLOCK": 4, "SEGMENT_DOCS": 60, "FIRST_WINDOW": 8, "LAST_WINDOW": 16, "GROUP_POSTINGS": 400, "QUERY_BLOCK": 7, "TERM_FILTER": term_filter}
    for name, value in small.items():
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(5)
    words = [f"W{i}" for i in range(60)] + ["É", "the", "x-y", "日本"]
    docs = [(None if i % 17 == 0 else i // 2, None if i % 23 == 0 else " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(500)]
    docs += [(9000 + i, "the very same words " * 3) for i in range(250)] + [(9999, "W1 " * 400 + "the")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(0, 8)))) for i in range(40)] + [(41, None), (42, ""), (43, "--"), (44, "absent"), (45, "the same"), (45, "the same")]
    frame = table([(i, t, "clash") for i, t in docs], "doc_id long, text string, score string").repartition(3)
    asked = table([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    got = sorted((tuple(r) for r in lexical.rank_documents(frame, asked).collect()), key=str)
    assert got == best_documents(docs, items[:-1])
    assert lexical.rank_documents(frame.limit(0), asked).collect() == lexical.rank_documents(frame, asked.limit(0)).collect() == []


def test_blocks_are_rejected_unopened(monkeypatch):
    """A rare term settles the worst score; of the common term's list only a few blocks are unpacked."""
    n = 20_000
    rare = np.arange(0, n, 1000)
    owner = np.r_[np.arange(n), rare]
    terms = np.r_[np.full(n, 1, np.uint64), np.full(len(rare), 2, np.uint64)]
    arrays = lexical.build_segment(list(range(n)), np.full(n, 10), terms, owner, np.ones(len(owner), np.int64))
    opened = []
    plain = lexical.Segment.unpack
    monkeypatch.setattr(lexical, "LAST_WINDOW", 1024)
    monkeypatch.setattr(lexical.Segment, "unpack", lambda self, b, first: (opened.append(b), plain(self, b, first))[1])
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))]
    lexical.Segment(arrays, n, 10 * n).search(np.array([1, 2], np.uint64), np.array([1, 6000]), best, 10)
    assert best[0][1].tolist() == rare[:10].tolist() and len(set(opened)) < 0.7 * len(arrays["last_doc"])
