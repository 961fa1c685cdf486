"""Similar sets: the size-aware join, and the products that verify blocks, against all pairs."""

import random

import numpy as np
import pytest

import __spark_entry__ as entry
from checks import compare
from tests.llm.helpers import AWKWARD, frame, prose, words
from tradelane.llm import linking, setjoin

SMALL = "/root/testdata/sf0.01"


def test_query_matches_sql(spark):
    name = "op13_set_join"
    assert compare.compare(spark, compare.connect(SMALL), name, entry.queries()[name],
                           entry.oracle_sql()[name], SMALL) is None


def shingle_set(text, k=3):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(texts, ids, percent):
    sets = [shingle_set(t) for t in texts]
    comp = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = comp[i], comp[j]
                comp = [y if c == x else c for c in comp]
    low = {}
    for c, i in zip(comp, ids, strict=True):
        if i is not None:
            low[c] = min(low.get(c, i), i)
    return [(i, len(s), low.get(c)) for i, s, c in zip(ids, sets, comp, strict=True)]


def near_copies(r, sizes, groups, copies):
    made = []
    for g in range(groups):
        base = prose(g, r.choice(sizes)).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randint(0, 1 + len(base) // 25)):
                at = r.randrange(len(w))
                w[at:at + r.randint(0, 1)] = [f"X{r.randrange(4)}"]
            made.append(" ".join(w))
    return made


@pytest.mark.parametrize("least_size", [None, 0, 13, 30])
def test_set_join(spark, monkeypatch, least_size):
    monkeypatch.setattr(linking, "BLOCK", 16)
    r = random.Random(3)
    made = near_copies(r, [4, 8, 11, 14, 21, 30], 14, 12) + near_copies(r, [60, 150, 400], 5, 30) + AWKWARD
    hot = prose(77, 40)
    made += [f"{hot} {prose(500 + i, 12)}" for i in range(40)]  # a passage that many share, without links
    ids = [*range(len(made) - 4), None, 7, 7, -1]
    got = setjoin.set_join(frame(spark, made, ids), least_size=least_size, records=500)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    rows = sorted((tuple(x) for x in got.collect()), key=repr)
    assert rows == sorted(brute_components(made, ids, 90), key=repr)


def test_set_join_of_repeated_rows_and_nothing(spark):
    docs = frame(spark, ["a b c d"] * 3 + [None, "", " "], ids=[4, 4, None, None, 9, 9])
    rows = sorted((tuple(x) for x in setjoin.set_join(docs).collect()), key=repr)
    assert rows == sorted([(4, 2, 4), (4, 2, 4), (None, 2, 4), (None, 0, None), (9, 0, 9), (9, 0, 9)], key=repr)
    assert setjoin.set_join(docs.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_least_common_and_partners(percent):
    for a in range(1, 60):
        for b in range(1, 60):
            need = next((c for c in range(min(a, b) + 1) if 100 * c >= percent * (a + b - c)), None)
            if need is None:
                assert setjoin.least_common(a, b, percent) > min(a, b)
            else:
                assert setjoin.least_common(a, b, percent) == need and b in setjoin.partners(a, percent)


def test_boundary_follows_cost():
    assert setjoin.boundary({20: 1000}, {20: 10}) < 20  # short lists are scanned
    assert setjoin.boundary({20: 1000}, {20: 10**9}) >= 20  # long ones are not
    assert setjoin.boundary({}, {}) == 0
    assert [setjoin.subset_count(n) for n in (1, 8, 9, 10, 20)] == [0, 0, 1, 11, 190 + 20 + 20 + 1 + 1]


@pytest.mark.parametrize("seed", range(6))
def test_blocks_decide_like_pairs(seed):
    r = np.random.default_rng(seed)
    measure = linking.Measure(80, counted=True)
    sides = []
    base = r.choice(10**6, 40, replace=False)
    for _ in range(2):
        ids, counts = [], []
        for _ in range(25):
            own = np.unique(np.where(r.random(40) < 0.08, r.integers(0, 10**6, 40), base)[:r.integers(0, 41)])
            c = np.where(r.random(len(own)) < r.random() * 0.3, r.integers(1, 60 if seed % 2 else 4, len(own)), 1)
            ids.append(own.astype("<u4").tobytes())
            counts.append(c.astype("<u4").tobytes() if (c > 1).any() else b"")
        sides.append((ids, counts))
    (a, ca), (b, cb) = sides
    linked, open_ = linking.similar_pairs(linking._Side(a, ca, measure), linking._Side(b, cb, measure), measure)
    assert open_.mean() < 0.6
    for i in range(25):
        for j in range(25):
            want = measure.similar(a[i], b[j], ca[i], cb[j])
            assert want == (linked[i, j] or (open_[i, j] and want)), (i, j)
            assert not (linked[i, j] and not want)
