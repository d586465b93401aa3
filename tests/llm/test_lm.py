"""The trie's scores against plain counting."""

import random

import brute_lm
import numpy as np
import pyarrow as pa
import pytest
from conftest_data import SF, docs_frame

from segtrace.llm import lm_trie
from segtrace.llm.elias_fano import EliasFano, read_arrays, write_arrays


@pytest.mark.parametrize(("universe", "n"), [(10, 3), (1000, 1000), (1 << 40, 5000), ((1 << 64) - 1, 3000), (5000, 0), (1, 1), (30_000, 20_000)])
def test_elias_fano(tmp_path, universe, n):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, universe, n, dtype=np.uint64))
    write_arrays(f"file://{tmp_path}/a.bin", EliasFano.encode(values, universe).arrays("x"))
    coded = EliasFano.of(read_arrays(f"{tmp_path}/a.bin"), "x")
    assert (coded.get(np.arange(len(values))) == values).all() if len(values) else True
    asked = np.concatenate([values, rng.integers(0, universe, 500, dtype=np.uint64)])
    place = {v: k for k, v in enumerate(values.tolist())}
    assert coded.find(asked).tolist() == [place.get(v, -1) for v in asked.tolist()]


def test_pointers_may_repeat():
    values = np.sort(np.random.default_rng(1).integers(0, 50, 1000, dtype=np.uint64))
    assert (EliasFano.encode(values, int(values[-1])).get(np.arange(1000)) == values).all()


def compare(got, want, step):
    assert {r.doc_id for r in got} == set(want)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (w["held_out"], w["n_tokens"], w["n_known"], w["train_tokens"])
        assert r.base_score == pytest.approx(w["base_score"], rel=1e-9)
        assert abs(r.score - w["score"]) <= step / 2 * 2 * r.n_tokens + 1e-6  # two quantised factors a token


def test_all_documents(spark):
    from segtrace.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    compare(QUERIES["op1_lm_trie"](spark, SF).collect(), brute_lm.score_all(docs), 1 / 32)


def test_many_parts_and_odd_rows(spark, monkeypatch):
    """Small parts and shards, null, empty, one-word and repeated texts, other columns of clashing names."""
    build = lm_trie.build_trie
    monkeypatch.setattr(lm_trie, "build_trie", lambda docs, text_col: build(docs, text_col, words_per_part=40, tokens_per_shard=60))
    rng = random.Random(2)
    docs = [(k, " ".join(rng.choice("a b c d e of the é x1 X1".split()) for _ in range(rng.randint(0, 30)))) for k in range(60)]
    docs += [(100, None), (101, ""), (102, " \t\n"), (103, "of"), (104, "OF\x0bthe\x85end"), (105, "hot pair " * 300)]
    compare(lm_trie.learn_and_score(docs_frame(spark, docs)).collect(), brute_lm.score_all(docs), 1 / 32)


def test_nothing_to_learn(spark):
    got = lm_trie.learn_and_score(docs_frame(spark, [])).collect()
    assert got == []
    trie = lm_trie.build_trie(docs_frame(spark, []))
    out = lm_trie.score_batch(trie, pa.array(["a b", None]))
    assert out["score"].tolist() == [0.0, 0.0] and out["n_tokens"].tolist() == [3, 1]


def test_probabilities_sum_to_one(spark):
    docs = [(k, t) for k, t in enumerate(["a b a", "b a c", "c c", "a b c a b"])]
    trie = lm_trie.build_trie(docs_frame(spark, docs))
    for context in ("a b", "b", "c c", "zzz"):
        total = 0.0
        for word in ("a", "b", "c", "unseen", None):
            text = f"{context} {word}" if word else context
            total += 10 ** token_score(trie, text, len(context.split()))
        assert total == pytest.approx(1, abs=0.12)  # rounding of two factors to 1/32 of a decade


def token_score(trie, text, place):
    """log10 probability of the token at a place: the difference that cutting the text there makes."""
    size, codes, hashes = lm_trie.tokens(pa.array([text]))
    ids = trie.numbers(hashes)
    known = ids >= 0
    count, before = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    count[known], before[known] = trie.counts(ids[known])
    single = (count + 1) / (trie.total + trie.vocabulary + 1)
    return np.log10(lm_trie._interpolated(trie, codes, ids, count, before, np.cumsum(size) - size, single[codes]))[place]


def test_lookups_in_a_shard_are_made_for_several_slices_and_shards(spark, monkeypatch):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices([f"w{k}" for k in range(300)], k=40))) for i in range(200)]
    trie = lm_trie.build_trie(docs_frame(spark, docs), tokens_per_shard=8)
    assert trie.shards > 1000 and trie.together == 8
    parts = [lm_trie.tokens(pa.array([text for _, text in docs[k : k + 20]])) for k in range(0, 160, 20)]
    looked, pairs = [], lm_trie.Trie.pairs
    monkeypatch.setattr(lm_trie.Trie, "pairs", lambda self, keys, shard: looked.append(len(np.unique(shard))) or pairs(self, keys, shard))
    together = [x["score"].tolist() for x in lm_trie.score_block(trie, parts)]
    assert len(looked) == 1
    assert together == [next(lm_trie.score_block(trie, [part]))["score"].tolist() for part in parts]
    whole = lm_trie.build_trie(docs_frame(spark, docs))
    assert whole.together == 1
    assert np.allclose(np.concatenate(together), np.concatenate([next(lm_trie.score_block(whole, [part]))["score"] for part in parts]), rtol=0, atol=1e-9)
