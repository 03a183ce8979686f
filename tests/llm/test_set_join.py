"""Operator 4 against all pairs, with sizes on both sides of the boundary."""

import random
import re
import time

import pytest

from tallyhouse.llm import components, set_join
from tallyhouse.llm.workers import find_package

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i if i is not None else -1), len(sets[k]), least.get(find(k), -1)) for k, (i, _) in enumerate(rows))


def corpus(seed, sizes, families, copies):
    """Families of edited copies at many distances, with passages that many documents share."""
    r = random.Random(seed)
    vocabulary = [a + b for a in "the in on er an to".split() for b in "xa ya za wo no lo".split()]
    passage = [r.choice(vocabulary) for _ in range(14)]
    rows, i = [], 0
    for _ in range(families):
        base = [r.choice(vocabulary) + str(r.randint(0, 9)) for _ in range(r.choice(sizes))]
        for _ in range(r.randint(1, copies)):
            words = list(base)
            for _ in range(r.randint(0, 2)):
                words[r.randrange(len(words))] = "edit" + str(r.randint(0, 99))
            if r.random() < 0.4:
                words = words + passage
            rows.append((i, " ".join(words)))
            i += 1
    r.shuffle(rows)
    return rows


def found(frame):
    return sorted(((r.doc_id if r.doc_id is not None else -1), r.n_shingles, (r.component_id if r.component_id is not None else -1)) for r in frame.collect())


@pytest.mark.parametrize("sizes", [(1, 3, 5, 6, 8, 10, 14), (20, 40, 60, 90)])
def test_equals_all_pairs(spark, table, sizes):
    find_package(spark)
    rows = corpus(5, sizes, 40, 6) + [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one\ttwo"), (3, "another text of id three"), (None, "One two")]
    docs = table([(*r, 0) for r in rows], "doc_id long, text string, n int").repartition(3)
    assert found(set_join.linked_documents(docs)) == brute_force(rows)


@pytest.mark.parametrize("limit", [0, 8, 20])
def test_the_boundary_changes_cost_alone(spark, table, monkeypatch, limit):
    find_package(spark)
    monkeypatch.setattr(set_join, "boundary", lambda costs: limit)
    rows = corpus(8, (4, 6, 8, 9, 10, 12, 16, 20, 24, 28), 30, 5)
    assert found(set_join.linked_documents(table(rows, "doc_id long, text string"))) == brute_force(rows)


def test_star_around_an_original(spark, table):
    """Copies that link with their original and not with each other are one component."""
    find_package(spark)
    base = [f"w{k}" for k in range(60)]
    rows = [(100, " ".join(base))]
    for k in range(30):
        words = list(base)
        words[2 * k % 50 + 5] = f"own{k}"
        rows.append((k, " ".join(words)))
    assert found(set_join.linked_documents(table(rows, "doc_id long, text string"))) == brute_force(rows)
    assert {c for _, _, c in brute_force(rows)} == {0}


def test_one_per_component(spark, table):
    find_package(spark)
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(4, text, "a"), (2, text, "b"), (2, text, "b"), (7, "something else", "c"), (8, None, "d"), (9, "", "e")]
    docs = table(rows, "doc_id long, text string, copies string")
    kept = set_join.one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 8, 9]


def test_one_per_component_goes_by_text(spark, table):
    """Null ids, and unlinked texts of one id, never stand for one another; linked texts of one id leave one."""
    find_package(spark)
    text = " ".join(f"w{k}" for k in range(30))
    near = text.replace("w29", "own")
    rows = [(None, "first of none"), (None, "second of none"), (None, "third of none"), (None, "third of none"), (None, None), (None, ""), (None, "\x0b")]
    rows += [(2, "one text of two"), (2, "quite another text"), (2, ""), (3, text), (3, near), (4, near), (None, text)]
    rows += [(5, "shared by five and six"), (5, "alone in five"), (6, "Shared by five and six"), (6, "alone in six")]
    got = [(r.doc_id, r.text) for r in set_join.one_per_component(table(rows, "doc_id long, text string")).collect()]
    of_three = [t for i, t in got if i == 3]
    assert len(of_three) == 1 and of_three[0] in (text, near)
    wanted = [r for k, r in enumerate(rows) if k not in (3, 10, 11, 12, 13, 16)]
    assert sorted(map(repr, [r for r in got if r[0] != 3])) == sorted(map(repr, wanted))


def test_empty(spark, table):
    find_package(spark)
    assert set_join.linked_documents(table([], "doc_id long, text string")).count() == 0


def test_components_of_a_long_path(spark, table):
    edges = table([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "u long, v long")
    assert sorted((r.node, r.root) for r in components.connected_components(edges).collect()) == [(k, 0) for k in range(61)] + [(100, 100), (101, 100)]


def test_subset_sizes_cover_every_linked_size():
    for n in range(1, 30):
        for m in range(1, 30):
            for both in range(1, min(n, m) + 1):
                assert (100 * both >= 80 * (n + m - both)) == (both >= set_join.need(n, m))
                if both >= set_join.need(n, m):
                    assert set_join.need(n, m) in set_join.subset_sizes(n) and n - both < set_join.listed(n)


@pytest.mark.parametrize("id_of", [lambda i: None, lambda i: 7], ids=["null ids", "one id"])
def test_ids_that_tell_nothing(spark, table, id_of):
    """2,000 texts, one in ten a near copy: what stands for a set is found by id and text, so ids that are shared cost no pairs."""
    find_package(spark)
    rng = random.Random(8)
    texts = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=40)) for _ in range(1800)]
    texts += [t + " z" for t in texts[:200]]
    took = []
    for name in (lambda i: i, id_of):
        started = time.perf_counter()
        docs = table([(name(i), t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
        rows = set_join._linked(docs.select("doc_id", "text")).collect()
        took.append(time.perf_counter() - started)
        assert len(rows) == 2000 and len({r.root for r in rows}) == 1800
    assert took[1] < 1.5 * took[0] + 5
