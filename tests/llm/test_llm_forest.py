"""LSH forest against brute force."""
import random
from collections import Counter

import numpy as np
import pytest

from keelson.llm import lsh_forest, queries
from tests.llm.conftest import ODD
from tests.llm.test_llm_dedup import family, shingles


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (k, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(k)
    least = {g: min((k for k in ks if k is not None), default=None) for g, ks in ids.items()}
    return Counter((k, len(s), least[find(i)], k == least[find(i)]) for i, ((k, _), s) in enumerate(zip(rows, sets)))


def found(df):
    return Counter(tuple(r) for r in lsh_forest.forest_components(df).collect())


def frame(llm, rows):
    return llm.createDataFrame(rows, "doc_id bigint, text string").repartition(4)


def edge_rows():
    """Families whose members lie on both sides of the least similarity."""
    texts = [t for seed, words, edits in [(1, 300, 5), (2, 60, 2), (3, 12, 1), (4, 700, 12), (5, 120, 2)] for t in family(seed, 25, words, edits)]
    return [(1000 - i, t) for i, t in enumerate(texts)]


def test_links_on_both_sides_of_the_bound(llm):
    rows = edge_rows()
    assert found(frame(llm, rows)) == brute(rows)


@pytest.mark.parametrize("region, deepest", [(4, 12), (6, 3)])
def test_large_regions_go_deeper_or_are_dealt(llm, monkeypatch, region, deepest):
    monkeypatch.setattr(lsh_forest, "REGION", region)
    monkeypatch.setattr(lsh_forest, "DEEPEST", deepest)
    rows = [(i, t) for i, t in enumerate(family(9, 60, 200, 2) + family(8, 20, 90, 1))]
    assert found(frame(llm, rows)) == brute(rows)


def test_values_stay_where_they_are_when_regions_are_cut(llm, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION", 4)
    plans, stored = [], lsh_forest.stored

    def noted(df, label):
        if label == "members":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(lsh_forest, "stored", noted)
    rows = [(i, t) for i, t in enumerate(family(9, 60, 200, 2))]
    assert found(frame(llm, rows)) == brute(rows)
    assert len(plans) > 2   # one for either set of trees, and one a cut
    assert all("Join" not in p.split("FlatMapCoGroupsInArrow")[0] for p in plans)


def test_many_copies_and_a_shared_passage(llm):
    rnd = random.Random(1)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [passage + " " + " ".join(f"w{rnd.randrange(10**6)}" for _ in range(30)) for _ in range(150)] + ["same text of several words here"] * 200
    rows = list(enumerate(texts))
    assert found(frame(llm, rows)) == brute(rows)


def test_odd_rows(llm, odd, none):
    assert found(odd) == brute(ODD)
    assert found(none) == Counter()


def test_query_equals_brute_force_on_the_whole_table(llm):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in llm.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in queries.QUERIES["op12_lsh_forest"](llm, path).collect())
    assert got == brute(rows)


def test_values_agree_as_often_as_sets_do():
    rnd = np.random.default_rng(2)
    h = rnd.integers(0, 2**64, 4000, dtype=np.uint64)
    a, b = h[:3400], h[600:]
    s = lsh_forest.signatures(np.concatenate([a, b]), np.array([0, 3400, 6800]))
    assert abs((s[0] == s[1]).mean() - 2800 / 4000) < 0.2
    orders = np.stack([lsh_forest.tree_order(t) for t in range(lsh_forest.TREES)])
    assert (np.sort(orders, axis=1) == np.arange(lsh_forest.HASHES)).all()
    assert len(np.unique(orders[:, :4])) == lsh_forest.HASHES
