"""Components of near duplicates against all pairs."""

import random

import pytest
from comparing import assert_same, duck
from conftest_data import DOCS, SF, docs_frame

from segtrace.llm.forest import Forest, components, deduplicate, near_duplicates
from segtrace.llm.queries import ORACLES, QUERIES


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(docs, percent):
    sets = [shingles(t) for _, t in docs]
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(docs[a][0]), find(docs[b][0])
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for (i, _), s in zip(docs, sets, strict=True)}


def test_equals_sql(spark):
    assert_same(QUERIES["op6_lsh_forest"](spark, SF), duck(SF), ORACLES["op6_lsh_forest"])


@pytest.mark.parametrize("percent", [80, 85])
def test_planted_groups(spark, percent):
    """Chains, crowds of similar texts and exact copies; windows of one neighbour leave work to the second pass."""
    rng = random.Random(percent)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    docs = []
    for _ in range(6):
        base = [word() for _ in range(120)]
        for _ in range(rng.randint(2, 25)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
                copy[rng.randrange(120)] = word()
            docs.append(" ".join(copy))
            base = copy if rng.random() < 0.5 else base
    docs = [(k, t) for k, t in enumerate(docs)] + [(900 + k, " ".join(word() for _ in range(50))) for k in range(20)]
    rng.shuffle(docs)
    want = brute(docs, percent)
    got = near_duplicates(docs_frame(spark, docs), percent, Forest(near=1, outside=4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_crowded_region_loses_no_link(spark):
    """Variants of one text that are alike but not linked crowd every region, and windows find nothing (sketch_least)."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base, docs = [word() for _ in range(400)], []

    def changed(text, n):
        text = list(text)
        for k in rng.sample(range(0, 400, 5), n):
            text[k] = word()
        return text

    for _ in range(50):
        one = changed(base, 6)
        docs += [one, changed(one, 8)]
    docs = [(k, " ".join(t)) for k, t in enumerate(docs)]
    rng.shuffle(docs)
    want = brute(docs, 80)
    assert len({c for _, c in want.values()}) > 25  # many components stay apart
    got = near_duplicates(docs_frame(spark, docs), 80, Forest(sketch_least=25, outside=1)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_odd_rows(spark):
    got = near_duplicates(docs_frame(spark, DOCS)).collect()
    assert len(got) == len(DOCS)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[2].component_id == 1 and not by[2].kept and by[1].kept
    assert by[3].n_shingles == by[4].n_shingles == by[5].n_shingles == 0 and by[6].n_shingles == 1 and by[8].n_shingles == 1
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    kept = deduplicate(docs_frame(spark, DOCS))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 3, 4, 5, 6, 7, 8] and len(kept.columns) == 9


def test_empty_table(spark):
    assert near_duplicates(docs_frame(spark, [])).count() == 0


def test_repeated_id_ties_classes(spark):
    a, b = " ".join("abcdefghij"), " ".join("klmnopqrst")
    got = {(r.doc_id, r.component_id) for r in near_duplicates(docs_frame(spark, [(1, a), (5, a), (5, b), (9, b)])).collect()}
    assert got == {(1, 1), (5, 1), (9, 1)}


@pytest.mark.parametrize("per_task", [200_000, 7])
def test_components_of_chains(spark, per_task):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 130), (130, 101), (7, 7)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), per_task).collect()}
    assert got == {**dict.fromkeys(range(2, 61), 1), 101: 100, 130: 100}
