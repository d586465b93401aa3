"""The pipeline, stage by stage, against plain versions on a small table."""

import re

import pytest
from conftest_data import DOCS, docs_frame
from test_decontaminate import ITEM
from test_forest import brute
from test_text_rules import base, counts, plain_bands

import corpus_pipeline as cp
from segtrace.llm.common import saved
from segtrace.llm.pii import KINDS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    out, docs = [], spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES:
        before, docs = docs, saved(stage(spark, docs, SF), "stage")
        out.append((before.collect(), docs.collect(), docs.columns))
    return out


def test_columns(stages):
    assert all(tuple(columns) == cp.COLUMNS for _, _, columns in stages[:-1]) and stages[-1][2] == [*cp.COLUMNS, "copy"]


def test_quality(stages):
    """What goes and what stays, by plain counts and ratios."""
    before, after, _ = stages[0]
    kept = {r.doc_id for r in after}
    for r in before:
        n, *_, repeats = counts(r.text or "")
        assert (r.doc_id in kept) == (n >= 20 and 100 * repeats <= 30 * n and plain_bands((r.text or "").encode())[-1])


def test_near_dedup(stages):
    before, after, _ = stages[1]
    roots = brute([(r.doc_id, r.text) for r in before], 80)
    assert {r.doc_id for r in after} == {root for _, root in roots.values()}


def test_benchmark(spark, stages):
    before, after, _ = stages[2]
    cut = lambda t: {tuple(w[k : k + 5]) for w in [t.lower().split()] for k in range(len(w) - 4)}
    asked = [cut(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in before if not any(len(cut(r.text) & a) >= 0.8 * len(a) for a in asked)}
    assert {r.doc_id for r in after} == clean and ITEM


def test_pii(stages):
    """No personal data of the contract's kinds is left, every text of such data is gone, and what lies between the masks is as it was."""
    before, after, _ = stages[3]
    new = {r.doc_id: r for r in after}
    assert new.keys() == {r.doc_id for r in before}
    masked = 0
    for r in before:
        text = new[r.doc_id].text
        assert base(text) == "" and new[r.doc_id].n_chars == len(text)
        pieces, at = re.split("<(?:" + "|".join(k.upper() for k in KINDS) + ")>", text), 0
        for piece in pieces:
            at = r.text.index(piece, at) + len(piece)
        masked += len(pieces) > 1
        assert len(pieces) > 1 or text == r.text
        assert not base(r.text) or text != r.text
    assert masked


def test_odd_rows(spark):
    """Null, empty, repeated and very long texts, null ids, columns of clashing names, and an empty table, through every stage."""
    for rows in (DOCS, []):
        frame = docs_frame(spark, rows)
        for _, stage in cp.STAGES:
            out = stage(spark, frame, SF)
            assert tuple(out.columns[:5]) == cp.COLUMNS
            got = out.collect()
            assert len(got) <= 2 * len(rows) and all(r.doc_id is None or r.doc_id in {i for i, _ in rows} for r in got)
    assert [r.doc_id for r in cp.benchmark(spark, docs_frame(spark, [(None, None), (3, None)]), SF).collect()].count(None) == 1
    assert {r.text for r in cp.pii(spark, docs_frame(spark, [(1, None), (2, "")]), SF).collect()} == {None, ""}


def test_mixing(stages):
    before, after, _ = stages[4]
    size = lambda r: counts(r.text)[0]
    total = sum(map(size, before))
    sources = {r.source for r in before}
    assert abs(sum(map(size, after)) - 1.5 * total) <= len(sources) * max(map(size, before))
    assert {r.doc_id for r in after} <= {r.doc_id for r in before} and {r.copy for r in after} <= {1, 2}


def test_run(spark, stages):
    rows = cp.run(spark, SF).collect()
    assert sorted((r.doc_id, r.copy) for r in rows) == sorted((r.doc_id, r.copy) for r in stages[-1][1])
