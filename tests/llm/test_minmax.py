"""Min-max hashing: signatures against plain permutations, links against all pairs."""

import numpy as np
import pyarrow as pa
import pytest

from lakepulse.llm import minmax, ngram_join
from lakepulse.llm.minmax import bands, likeness, min_max, near_duplicates, permuted
from lakepulse.llm.text import mix

from .test_text_operators import SCHEMA, brute_components, corpus, lowered, passage  # noqa: F401

U = np.uint64


def test_signatures_are_least_and_greatest_values_of_each_permutation(monkeypatch):
    monkeypatch.setattr(minmax, "AT_ONCE", 50)
    rng = np.random.default_rng(1)
    counts = [0, 1, 3, 0, 200, 17, 0]
    first = np.concatenate([[0], np.cumsum(counts)])
    tokens = rng.integers(0, 2**63, first[-1], dtype=np.uint64)
    got = min_max(tokens, first, 8)
    hashed = mix(tokens.copy(), 60)
    for r, (s, e) in enumerate(zip(first[:-1], first[1:])):
        for k in range(8):
            values = permuted(hashed[s:e], k)
            assert (got[r, k], got[r, 8 + k]) == ((values.min(), values.max()) if e > s else (0, 0))
    assert len(np.unique(permuted(np.arange(100_000, dtype=U), 3))) == 100_000


def test_estimates_are_unbiased_and_vary_less_than_minima_alone():
    """400 pairs of sets of one similarity: 64 permutations give 128 values whose mean is the similarity; as many minima of 64 vary more."""
    rng, n, common = np.random.default_rng(2), 120, 90
    true = common / (2 * n - common)
    both, minima = [], []
    for _ in range(400):
        shared = rng.integers(0, 2**63, common, dtype=np.uint64)
        x, y = (np.concatenate([shared, rng.integers(0, 2**63, n - common, dtype=np.uint64)]) for _ in range(2))
        a, b = min_max(np.concatenate([x, y]), np.array([0, n, 2 * n]))
        both.append(likeness(a, b))
        minima.append(likeness(a[:64], b[:64]))
    assert abs(np.mean(both) - true) < 4 * np.std(both) / 20
    assert np.var(both) < 0.75 * np.var(minima)
    assert np.var(both) == pytest.approx(true * (1 - true) / 128, rel=0.35)


def test_bands_keep_minima_and_maxima_apart():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, (2, 16), dtype=np.uint64)
    b = a.copy()
    b[0, 8:] = 1
    found, other = bands(a, 4), bands(b, 4)
    assert found.shape == (2, 4) and (found[0, :2] == other[0, :2]).all() and (found[0, 2:] != other[0, 2:]).all() and (found[1] == other[1]).all()
    same = bands(np.concatenate([a[:, :8], a[:, :8]], axis=1), 4)
    assert (same[:, :2] != same[:, 2:]).all()


def test_signatures_of_a_table(spark, corpus):  # noqa: F811
    rows = minmax.signatures(spark.createDataFrame(corpus, SCHEMA), permutations=4).collect()
    sizes = {i: v[0] for i, v in brute_components(corpus, 3, 85, lowered).items()}
    assert {r.row.doc_id: r.n_shingles for r in rows} == sizes and all(r.row.answers == "clash" for r in rows)
    signed = {r.row.doc_id: r.signature for r in rows}
    assert signed[0] is signed[1] is signed[2] is None and len(signed[3]) == 8 and signed[5] == signed[6] != signed[7]


@pytest.mark.parametrize("n, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, corpus, n, percent):  # noqa: F811
    found = near_duplicates(spark.createDataFrame([*corpus, (None, "one", 1, "")], SCHEMA), n=n, percent=percent).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert got.pop(None) == (1, None)
    assert got == brute_components(corpus, n, percent, lowered)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def edited(rng, base, edits, i):
    own = list(base)
    for k in rng.choice(len(base), edits, replace=False):
        own[k] = f"edit{rng.integers(0, 3)}"
    return i, " ".join(own)


@pytest.mark.parametrize("edits", [4, 6, 8])
def test_near_copies_around_the_threshold(spark, monkeypatch, edits):
    """A large group whose members lie just above and below the threshold of each other, in blocks much smaller than it."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 32)
    monkeypatch.setattr(ngram_join, "LEADERS", 4)
    rng, base = np.random.default_rng(edits), passage(21, 160).split()
    rows = [edited(rng, base, edits, i) for i in range(240)] + [(1000 + i, passage(100 + i, 50)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute_components(rows, 3, 85, lowered)


def test_no_link_of_two_thousand_pairs_at_the_threshold_is_lost(spark):
    """Pairs of different passages, each of similarity between 0.85 and 0.9."""
    rng, rows = np.random.default_rng(9), []
    for i in range(2000):
        own = [f"w{v}" for v in rng.integers(0, 10**9, 60)]
        # Four words changed at one end: 58 shingles, 54 of them shared, of 62.
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own[:56] + [f"x{v}" for v in rng.integers(0, 10**9, 4)]))]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in got} and len(got) == 4000


def test_rows_of_blocks_grow_with_the_group_not_with_its_square(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 64)
    monkeypatch.setattr(ngram_join, "LEADERS", 8)
    count = lambda m: ngram_join._with_leaders(spark.range(m).selectExpr("0L as first", "1L as second", "id as doc_id", "50L as n", "id as component")).count()
    few, many = count(2000), count(16_000)
    assert many < 9 * few and many < 16_000 * 1.4


def test_chunks_do_not_matter(spark, monkeypatch):
    texts = pa.array([passage(i, 30) for i in range(20)])
    whole = ngram_join.Sets(texts, 3, True)
    one = min_max(whole.token, whole.first, 4)
    for i in range(20):
        own = ngram_join.Sets(texts[i : i + 1], 3, True)
        assert (min_max(own.token, own.first, 4)[0] == one[i]).all()
