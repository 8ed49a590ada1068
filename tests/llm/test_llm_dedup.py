"""Jaccard join, suffix repeats, fingerprints."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from keelson.llm import backoff_lm, iblt, links, lsh_forest, packed, queries, signature_tree, suffix_repeats, textbytes
from keelson.llm.textbytes import SpanHash
from keelson.session import shared_dir
from tests.llm.conftest import LONG, ODD

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# ------------------------------------------------------------------ Jaccard join

def shingles(text):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least.setdefault(find(i), []).append(k)
    ids = {g: min((k for k in ks if k is not None), default=None) for g, ks in least.items()}
    return Counter((k, len(s), ids[find(i)]) for i, ((k, _), s) in enumerate(zip(rows, sets)))


def family(seed, members, words, edits):
    """Near copies: one text with ``edits`` of its words replaced, anew for each member."""
    rnd = random.Random(seed)
    base = [f"{rnd.choice('abcdefgh')}{rnd.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(members):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(words)] = f"n{rnd.randrange(10**9)}"
        out.append(" ".join(w))
    return out


def found(df):
    return Counter(tuple(r) for r in signature_tree.jaccard_components(df).collect())


def test_components_match_brute_force(llm, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(docs) == brute_components(rows)


def test_near_copies_around_the_threshold(llm):
    texts = family(1, 40, 120, 6) + family(2, 25, 60, 4) + family(3, 25, 300, 14) + family(4, 10, 4, 1) + family(5, 8, 6, 1)
    rows = list(enumerate(t if i % 3 else t.upper() for i, t in enumerate(texts)))
    random.Random(9).shuffle(rows)
    assert found(llm.createDataFrame(rows, "doc_id bigint, text string").repartition(5)) == brute_components(rows)


def test_exact_step_alone_finds_every_link(llm, monkeypatch):
    """Without the quick step's trees, the crossing step must give the same components."""
    rows = list(enumerate(family(6, 30, 100, 5) + family(7, 30, 80, 9)))
    df = llm.createDataFrame(rows, "doc_id bigint, text string")
    # every class in a tree of its own
    monkeypatch.setattr(signature_tree, "_tree_keys",
                        lambda sets, classes: sets.selectExpr("uid", "0 AS which", "uid AS key", "0L AS deal"))
    assert found(df) == brute_components(rows)
    monkeypatch.setattr(signature_tree, "BLOCK_CLASSES", 7)   # many pairs of blocks
    assert found(df) == brute_components(rows)


def test_tree_prunes_no_link():
    rnd = np.random.default_rng(0)
    base = [np.unique(rnd.integers(0, 2**63, int(rnd.integers(5, 200)), dtype=np.uint64)) for _ in range(12)]
    sets = []
    for b in base:
        for _ in range(6):
            keep = b[rnd.random(len(b)) > rnd.random() * 0.25]
            sets.append(np.union1d(keep, rnd.integers(0, 2**63, int(rnd.integers(0, 4)), dtype=np.uint64)))
    size = np.array([len(s) for s in sets])
    for bits in (64, 1024):
        tree = signature_tree.Tree(size, size, signature_tree.bitmaps(sets, bits), np.arange(len(sets)), -1)
        kept = {tuple(sorted(p)) for a, b in tree.pairs(chunk=50) for p in zip(a.tolist(), b.tolist())}
        for i in range(len(sets)):
            for j in range(i):
                if len(sets[i]) and len(sets[j]) and signature_tree.is_link(sets[i], sets[j]):
                    assert (j, i) in kept


def test_join_edges(odd, none):
    rows = [(i, t) for i, t in ODD]
    assert found(odd) == brute_components(rows)
    assert found(none) == Counter()
    kept = signature_tree.one_of_each(odd).collect()
    assert set(signature_tree.one_of_each(odd).columns) == set(odd.columns)
    assert Counter(r.doc_id for r in kept) == Counter({1: 1, 2: 1, 3: 1, 4: 1, 5: 1, None: 1, 8: 1, 10: 1, 11: 1, 12: 1})


def test_linked_groups(llm):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1080)] + [(5, 5)]
    got = {r.node: r.group for r in links.linked_groups(llm.createDataFrame(edges, "a bigint, b bigint")).collect()}
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    assert set(got) == set(near)
    seen = set()
    for n in near:
        if n not in seen:
            part, todo = {n}, [n]
            while todo:
                new = near[todo.pop()] - part
                part |= new
                todo += new
            seen |= part
            assert len({got[x] for x in part}) == 1 and got[n] in part
    assert links.linked_groups(llm.createDataFrame([], "a bigint, b bigint")).count() == 0


# ------------------------------------------------------------------ suffix repeats

def brute_repeats(rows):
    texts = sorted(((k if k is not None else 2**63, (t or "").encode()) for k, t in rows), key=lambda x: x[0])
    first = {}
    for k, b in texts:
        for i in range(len(b) - 49):
            first.setdefault(b[i : i + 50], k)
    out = Counter()
    for k, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < k:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[(None if k == 2**63 else k, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def removed(df):
    return Counter(tuple(r) for r in suffix_repeats.without_repeats(
        df.select("doc_id", "text"), suffix_repeats.digests, suffix_repeats.DIGESTS).collect())


def test_repeats_match_brute_force(docs):
    assert removed(docs) == brute_repeats([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_repeats_of_all_kinds(llm):
    rnd = random.Random(4)
    alpha = lambda n: "".join(rnd.choice("abcd é\n") for _ in range(n))
    passages = [alpha(n) for n in (49, 50, 51, 84, 85, 120, 400)] + ["ab" * 60, "a" * 130, "\x00" * 70]
    rows = []
    for i in range(120):
        parts = [alpha(rnd.randrange(60)) for _ in range(3)]
        parts.insert(1, rnd.choice(passages))
        if i % 2:
            p = rnd.choice(passages)
            parts.insert(3, p[rnd.randrange(len(p)) // 2 :])
        rows.append((rnd.randrange(100), "".join(parts)))
    df = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert removed(df) == brute_repeats(rows)


def test_repeat_edges(llm, odd, none):
    short = [(i, t) for i, t in ODD if t is None or len(t) < 10000]
    assert removed(llm.createDataFrame(short, "doc_id bigint, text string")) == brute_repeats(short)
    rows = {r.doc_id: r for r in suffix_repeats.without_repeats(odd, suffix_repeats.kept_texts, odd.schema).collect()}
    assert rows[9].text == "" and rows[8].text.startswith("word0") and rows[9].n_chars == 0 and rows[1].text == ""
    assert removed(none) == Counter()


def test_hot_anchors_lose_no_repeat(llm):
    rnd = random.Random(6)
    alpha = lambda n: "".join(rnd.choice("abcd é\n") for _ in range(n))
    phrase, passage = alpha(40), alpha(45)
    rows = [(rnd.randrange(150) or None, alpha(rnd.randrange(50)) + rnd.choice([phrase, passage + phrase, phrase + passage])
             + alpha(rnd.randrange(50))) for _ in range(200)] + [(i, "a" * 130) for i in range(5)] + [(9, None), (9, "")]
    df = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for split in (0, 3, 40):
        got = suffix_repeats.without_repeats(df, suffix_repeats.digests, suffix_repeats.DIGESTS, split=split)
        assert Counter(tuple(r) for r in got.collect()) == brute_repeats(rows)


def test_a_frequent_phrase_in_differing_contexts_is_spread(llm, monkeypatch):
    rnd = random.Random(7)
    alpha = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    least = lambda t: suffix_repeats.GramHash(np.frombuffer(t.encode(), np.uint8)).every(suffix_repeats.GRAM).min()
    phrase = min((alpha(40) for _ in range(3000)), key=least)   # its least gram is the anchor of the windows around it
    rows = [(i, alpha(30) + phrase + alpha(30)) for i in range(6000)] + [(7000, rnd.choice("ab") * 3)]
    rows += [(8000 + i, rows[i][1]) for i in range(0, 6000, 500)]
    calls = []

    def exchange(blocks, buckets, send, *more):
        calls.append((blocks, buckets, send))
        return packed.exchange(blocks, buckets, send, *more)

    monkeypatch.setattr(suffix_repeats, "exchange", exchange)
    assert removed(llm.createDataFrame(rows, "doc_id bigint, text string").repartition(4)) == brute_repeats(rows)
    blocks, buckets, send = calls[-1]   # that of the segments
    load = Counter()
    for (blob,) in blocks.select("blob").collect():
        h, payload = send(packed.unpack_batch(blob))
        which, bounds = packed.bucket_bounds(h, buckets)
        for k, lo, hi in zip(which.tolist(), bounds.tolist(), bounds[1:].tolist()):
            load[k] += len(payload(lo, hi))
    assert max(load.values()) < 0.25 * sum(load.values())


def test_suffix_array_holds_repeated_windows_only(monkeypatch):
    rnd = random.Random(8)
    phrase = rnd.randbytes(60)
    own = lambda i: bytes([i // 4])
    texts = [rnd.randbytes(11) + own(i) + phrase + own(i) + rnd.randbytes(11) if i % 4 == 0 else rnd.randbytes(84) for i in range(400)]
    bounds, held = np.concatenate([[0], np.cumsum([len(t) for t in texts])]), []
    scan = suffix_repeats.repeat_groups
    monkeypatch.setattr(suffix_repeats, "repeat_groups", lambda lengths, *more: held.append(len(lengths) + 1) or scan(lengths, *more))
    got = suffix_repeats.covered_by_smaller(np.frombuffer(b"".join(texts), np.uint8), bounds, np.arange(400))
    assert held == [100 * 11]   # the phrase's windows, not all 14,000
    want = np.zeros(len(got), bool)
    for i in range(4, 400, 4):
        want[bounds[i] + 12 : bounds[i] + 72] = True
    assert (got == want).all()


def test_hashes_do_not_depend_on_the_steps(monkeypatch):
    data = np.frombuffer(random.Random(9).randbytes(3000), np.uint8)
    offsets = np.array([0, 10, 10, 1200, 1249, 3000])
    start = np.arange(0, 2900, 7)

    def made():
        return [SpanHash(data)(start, start + 61), textbytes.GramHash(data).every(16), textbytes.GramHash(data).at(start, 50),
                *suffix_repeats.segments(data, offsets)]

    whole = made()
    for module in (textbytes, suffix_repeats):
        monkeypatch.setattr(module, "STEP", 37)
    assert all((a == b).all() for a, b in zip(whole, made()))


def test_code_points_go_only_as_a_whole():
    text = "aé" * 30
    data, offsets = suffix_repeats.flat(pa.array([text]))
    covered = np.zeros(len(data), bool)
    covered[2:50] = True   # from inside an é
    rows = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text], "n_chars": [60]})
    out = suffix_repeats.kept_texts(rows, data, offsets, covered).to_pylist()[0]
    assert out["text"] == "aé" + text[text.index("a", 1) + 32 :] or out["text"].startswith("aé")
    assert len(out["text"]) == out["n_chars"]


def test_interval_tree_outputs_maximal_groups_with_all_occurrences():
    passage = b"0123456789" * 6
    segments = [b"x" + passage, b"y" + passage, b"z" + passage, passage[:55]]
    data = np.frombuffer(b"".join(segments), np.uint8)
    bounds = np.cumsum([0] + [len(s) for s in segments])
    covered = suffix_repeats.covered_by_smaller(data, bounds, np.array([5, 2, 7, 9]))
    parts = [covered[a:b] for a, b in zip(bounds, bounds[1:])]
    assert parts[0].tolist() == [False] + [True] * 60 and parts[2].tolist() == [False] + [True] * 60
    assert not parts[1].any() and parts[3].all()


# ------------------------------------------------------------------ fingerprints

def paragraphs(text):
    out = Counter()
    for line in re.split("(?<=\n)", text):
        for s in re.split("(?<=[.!?] )", line):
            b = s.encode()
            for i in range(0, len(b), 200):
                x = b[i : i + 200]
                if x := x[:-1] if x.endswith(b"\n") else x:
                    out[x] += 1
    return out


def alike(a, b):
    every = sum((a | b).values())
    return sum((a & b).values()) / every if every else 1.0


def check_edits(df, rows):
    rows = sorted(((-(2**63) if k is None else k), t or "", k is None) for k, t in rows)
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in iblt.with_edits(df).collect())
    want = Counter()
    for i, (k, t, null) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        e = iblt.edited_text(t, after)
        want[(None if null else k, len(t), hashlib.sha256(e.encode()).hexdigest(), round(alike(paragraphs(t), paragraphs(e)), 9),
              round(alike(paragraphs(t), paragraphs(after)), 9))] += 1
    assert got == want


def test_fingerprints_match_brute_force(docs):
    check_edits(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_fingerprint_edges(llm, odd, none):
    check_edits(odd, ODD)
    assert iblt.with_edits(none).count() == 0
    one = iblt.with_edits(llm.createDataFrame([(4, "abcd")], "doc_id bigint, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def test_equal_texts_have_equal_fingerprints(docs):
    rows = docs.select("doc_id", "text").collect()
    h, bounds, whole = iblt.paragraphs(pa.array([r.text for r in rows]))
    prints = iblt.fingerprints(h, bounds, whole)
    assert len(set(prints)) == len({r.text for r in rows})


@pytest.mark.parametrize("n", [0, 1, 20, 60, 700])
def test_returned_fingerprints_of_edited_texts_subtract(n):
    texts = ["".join(f"line {i} of {k}\n" for i in range(m)) for k, m in (("a", n), ("b", n + n // 8))]
    texts.append(iblt.edited_text(*texts))
    h, bounds, whole = iblt.paragraphs(pa.array(texts))
    prints, of = iblt.fingerprints(h, bounds, whole), [h[x:y] for x, y in zip(bounds, bounds[1:])]
    for i, j in ((0, 2), (2, 0), (0, 1)):
        key, sign = iblt.print_differences(prints[i], prints[j])
        assert set(key[sign > 0].tolist()) == set(of[i].tolist()) - set(of[j].tolist())
        assert set(key[sign < 0].tolist()) == set(of[j].tolist()) - set(of[i].tolist())


def test_fingerprints_do_not_depend_on_their_neighbours(docs):
    texts = [r.text for r in docs.select("text").limit(50).collect()] + ["x\n" * 99999, None]
    alone = [iblt.fingerprints(*iblt.paragraphs(pa.array([t], pa.string())))[0] for t in texts]
    assert iblt.fingerprints(*iblt.paragraphs(pa.array(texts))) == alone


@pytest.mark.parametrize("shared,apart", [(0, 0), (50, 0), (50, 3), (10, 200), (0, 5000)])
def test_peeling_recovers_exactly_the_differences(shared, apart):
    rnd = np.random.default_rng(shared + apart)
    both = rnd.integers(0, 2**63, shared, dtype=np.uint64)
    a, b = (np.concatenate([both, rnd.integers(0, 2**63, apart, dtype=np.uint64)]) for _ in range(2))
    row, key, sign = iblt.differences((a, np.array([0, len(a)])), (b, np.array([0, len(b)])))
    assert set(key[sign > 0].tolist()) == set(a.tolist()) - set(b.tolist())
    assert set(key[sign < 0].tolist()) == set(b.tolist()) - set(a.tolist())
    assert len(key) == 2 * apart and not row.any()


# ------------------------------------------------------------------ packed exchange

def test_shared_and_counted_keys(llm):
    rows = [(i, " ".join(str(x) for x in {i % 7, 100 + i, 3000})) for i in range(400)]
    df = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    blocks = packed.pack(df, block_bytes=300)
    assert blocks.count() > 10

    def keys(batch):
        every = np.concatenate([np.unique([int(x) for x in t.split()]) for t in batch.column("text").to_pylist()]).astype(np.uint64)
        from keelson.llm.textbytes import mix
        return mix(every + np.uint64(1))

    def distinct(batch):
        h, n = np.unique(keys(batch), return_counts=True)
        return h, n > 1

    def each(part, number, batch, got, block):
        h, _ = np.unique(keys(batch), return_counts=True)
        mask = packed.shared_mask(h, 16, {-1 - k: v for k, v in got.items() if k < 0})
        total = packed.key_totals(h, 16, {k: v for k, v in got.items() if k >= 0})
        yield pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64)), "shared": pa.array(mask), "total": pa.array(total)})

    shared = packed.shared_keys(blocks, 16, distinct)
    totals = packed.counted_keys(blocks, 16, lambda b: np.unique(keys(b), return_counts=True))
    both = shared.selectExpr("part", "-1 - bucket AS bucket", "reply").unionByName(totals)
    got = {r.h: (r.shared, r.total) for r in packed.with_replies(blocks, both, each, "h bigint, shared boolean, total bigint").collect()}
    want = Counter(x for _, t in rows for x in t.split())
    assert len(got) == len(want) and Counter(v[1] for v in got.values()) == Counter(want.values())
    assert all(s == (n > 1) for s, n in got.values()) and len(LONG) > 0


# ------------------------------------------------------------------ shared helpers

def unlike(k):
    """Two different strings of 2**k letters that collide under any polynomial modulo 2**64."""
    a, b = "a", "b"
    for _ in range(k):
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("k", [9, 10, 11, 12])
def test_span_hashes_tell_structured_strings_apart(k):
    a, b = unlike(k)
    data = np.frombuffer((a + b + a).encode(), np.uint8)
    n = len(a)
    h = SpanHash(data)(np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n]))
    assert h[0] == h[2] != h[1]


def test_structured_strings_are_different_words_everywhere(llm):
    a, b = unlike(10)
    rows = [(1, f"{a} one two three four"), (2, f"{b} one two three four"), (3, f"{a} {b} {a}"), (4, f"{b} {b} {a}")]
    df = llm.createDataFrame(rows, "doc_id bigint, text string")
    assert found(df) == brute_components(rows)
    assert {r.doc_id: r.component_id for r in lsh_forest.forest_components(df).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    scores = {r.doc_id: r.log_score for r in backoff_lm.backoff_scores(df, order=1).collect()}
    counts = Counter(w for _, t in rows for w in t.split())
    total = sum(counts.values())
    want = {i: sum(np.log(counts[w] / total) for w in t.split()) for i, t in rows}
    assert scores == pytest.approx(want)
    got = {r.doc_id: r.n_removed for r in suffix_repeats.without_repeats(df, suffix_repeats.digests, suffix_repeats.DIGESTS).collect()}
    assert got == {i: n for i, n in brute_removed(rows).items()}


def brute_removed(rows):
    out = {}
    for i, text in rows:
        t, gone = text.encode(), set()
        for p in range(len(t) - 49):
            if any(j < i and t[p : p + 50] in other.encode() for j, other in rows):
                gone.update(range(p, p + 50))
        out[i] = len(gone)
    return out


def test_keys_survive_the_exchange():
    rnd = np.random.default_rng(0)
    for n in (0, 1, 7, 1000):
        h = np.sort(rnd.integers(0, 2**64, n, dtype=np.uint64))
        got, end = packed.unpacked_keys(packed.packed_keys(h) + b"more")
        assert got.tolist() == h.tolist() and (packed.packed_keys(h) + b"more")[end:] == b"more"
    values = [b"", b"x", b"yz" * 50]
    assert packed.unframed(packed.framed([5, 1 << 40, 7], values)) == ([5, 1 << 40, 7], values)


def test_a_long_chain_needs_few_rounds(llm, monkeypatch):
    rounds = []
    monkeypatch.setattr(links, "drop", lambda *frames: rounds.append(len(frames)) or packed.drop(*frames))
    n = 10_000
    chain = llm.range(n).selectExpr("id AS a", "id + 1 AS b")
    got = links.linked_groups(chain).agg(F.count("*"), F.countDistinct("group")).first()
    assert tuple(got) == (n + 1, 1)
    assert sum(x == 2 for x in rounds) < 20


def test_exchange_rows_follow_the_parts(llm):
    """One row for each part and bucket at most, however many blocks a part has."""
    docs = llm.range(4000).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 40) AS text").coalesce(1)
    blocks = packed.pack(docs, block_bytes=4000)
    parts = blocks.select("part").distinct().count()
    assert blocks.count() > 5 * parts
    seen = packed.exchange(blocks, 16, lambda rows: (np.arange(0, 2**63, 2**58, dtype=np.uint64), lambda x, y: b"."), lambda p: p)
    assert seen.count() <= parts * 16


def test_only_the_result_stays(llm):
    """A query's intermediate tables are gone once it has its result."""
    before = stored_folders(llm)
    for name in ("op5_hilbert_packing", "op6_signature_tree", "op7_suffix_repeats", "op11_turn_repair", "op12_lsh_forest",
                 "op13_hard_negatives"):
        out = queries.QUERIES[name](llm, "/root/testdata/sf0.001")
        now = stored_folders(llm)
        assert len(now - before) == 1, (name, now - before)
        assert out.count() > 0
        before = now


def stored_folders(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark) + "/scratch")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {str(x.getPath().getName()) for x in fs.listStatus(path)} if fs.exists(path) else set()
