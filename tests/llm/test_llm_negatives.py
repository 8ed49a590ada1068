"""Hard negatives against brute force."""
import numpy as np
import pyarrow as pa
import pytest

from keelson.llm import hard_negatives as H

SCHEMA = "vec_id bigint, label bigint, vector array<bigint>, anchor boolean"


def brute(rows):
    rows = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None]
    score = lambda x, y: sum(a * b for a, b in zip(x, y))
    out = []
    for i, label, v, anchor in rows:
        if not anchor:
            continue
        found = sorted((-score(v, w), k, l) for k, l, w, _ in rows if k is not None)
        for s, k, _ in [x for x in found if x[2] == label and x[1] != i][:5]:
            fit = [x for x in found if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, k, n + 1, y, -s, -t) for n, (t, y, _) in enumerate(fit)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in H.hard_negatives(df).collect())


def vectors(seed, n, wide, spread, labels=4):
    """Directions around a few centres, with lengths that differ, and a hot vector in a third of the rows."""
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, wide)) ** 3
    out = []
    for i in range(n):
        v = centres[i % 6] + spread * rnd.normal(size=wide)
        v = centres[0] if i % 3 == 0 else v * rnd.lognormal(sigma=0.7)
        out.append((i, int(rnd.integers(labels)), [int(x) for x in np.floor(100 * v / np.linalg.norm(centres[0]))], i % 20 == 0))
    return out


@pytest.mark.parametrize("spread", [0.1, 1.0])
def test_equals_brute_force_over_many_buckets(llm, monkeypatch, spread):
    monkeypatch.setattr(H, "BUCKET_ROWS", 37)
    rows = vectors(1, 700, 8, spread)
    assert mined(llm.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


def test_coordinate_bounds_prune_and_keep_all_that_reach():
    rnd = np.random.default_rng(4)
    rows = np.floor(1000 * H.unit(rnd.normal(size=(500, 6)) ** 3)[0]).astype(np.int64)  # one length bucket
    _, length = H.unit(rows)
    lists = np.argsort(H.unit(rows)[0], axis=0, kind="stable").astype(np.uint16)
    batch = pa.RecordBatch.from_pydict({"vec_id": pa.array(range(500), pa.int64()), "label": pa.array([0] * 500, pa.int64()),
                                        "vector": pa.array(list(rows), pa.list_(pa.int64()))})
    bucket = H.Bucket(H.pack_batch(batch), pa.compress(lists.tobytes(), "zstd", asbytes=True), float(length.max()))
    q = rows[::10]
    u, size = H.unit(q)
    all_scores = q @ rows.T
    reach = np.partition(all_scores, -5, axis=1)[:, -5]
    looked = 0
    for at, some in bucket.candidates(u, size, reach):
        some = np.arange(500) if some is None else some
        looked += len(at) * len(some)
        for k in at:
            assert set(np.flatnonzero(all_scores[k] >= reach[k])) <= set(some.tolist())
    assert looked < all_scores.size / 4


def test_odd_rows(llm):
    rows = [(None, 1, [1, 2], True), (1, None, [1, 2], True), (2, 1, None, False), (0, 1, [3, 4], True), (0, 1, [3, 4], True), (5, 1, [3, 4], False),
            (6, 1, [], False), (7, 2, [2], False), (8, 2, [2, 2, 9], None), (9, 2, [2, 2], False), (9, 2, [2, 2], False), (10, 3, [0, 0], True),
            (11, 3, [-1, 0], True), (12, 5, [], True)]
    df = llm.createDataFrame([(*r, 1, 2, b"x") for r in rows], SCHEMA + ", part int, reach int, block binary")
    assert mined(df) == brute(rows)
    assert mined(df.limit(0)) == []
    raw = llm.createDataFrame([(1, [1.0, None]), (2, [float("nan")]), (3, [float("-inf")]), (4, None), (5, [0.5, -0.001]), (6, [])],
                              "vec_id bigint, embedding array<float>")
    kept = raw.filter(H.usable(raw.embedding)).select("vec_id", H.quantized(raw.embedding)).collect()
    assert [tuple(r) for r in kept] == [(5, [128, -1]), (6, [])]


def test_scores_are_exact_or_refused():
    big = np.array([[3 * 10**9]])
    assert H.scores(big, big).tolist() == [[9 * 10**18]]
    small = np.array([[2**26 + 1, 5]])
    assert H.scores(small, small).tolist() == [[(2**26 + 1) ** 2 + 25]]
    with pytest.raises(OverflowError):
        H.scores(np.array([[2**62]]), np.array([[2**3]]))
