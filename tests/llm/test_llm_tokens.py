"""Packing, language model, SentencePiece, pipeline."""
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from keelson.llm import backoff_lm, hilbert_pack, queries, sp_viterbi
from tests.llm.conftest import ODD

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ packing

def test_hilbert_curve_visits_every_cell_by_unit_steps():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        index = hilbert_pack.hilbert_index(cells, bits)
        assert sorted(index.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check_packing(df, rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BPE)
    pieces = hilbert_pack.packed_pieces(df, BPE, with_ids=True).collect()
    sequences = defaultdict(list)
    texts = defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) and zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
        sequences[p.sequence_id].append(p)
        texts[p.doc_id].append(p)
    for s, ps in sequences.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 2048 or s == max(sequences) and at < 2048
    assert sorted(sequences) == list(range(len(sequences)))
    want = defaultdict(Counter)
    for k, t in rows:
        want[k][len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1] += 1
    for k, ps in texts.items():
        assert sum(p.length for p in ps) == sum(n * c for n, c in want[k].items())
        assert {p.doc_tokens for p in ps} == set(want[k])
        if sum(want[k].values()) == 1:
            ids = [i for p in sorted(ps, key=lambda p: p.start) for i in p.ids]
            text = next(t for i, t in rows if i == k)
            assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
    assert set(texts) == set(want)


def test_packing(docs):
    check_packing(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_packing_edges(odd, none):
    check_packing(odd, ODD)
    assert hilbert_pack.packed_pieces(none, BPE).count() == 0


def test_neighbours_on_the_curve_are_alike():
    rnd = np.random.default_rng(1)
    vectors = hilbert_pack.projection(1000)
    topics = [rnd.choice(1000, 30) for _ in range(8)]
    ids = np.concatenate([rnd.choice(topics[i % 8], 300) for i in range(80)])
    keys = hilbert_pack.curve_keys(ids, np.arange(0, 80 * 300 + 1, 300), vectors)
    order = np.argsort(keys) % 8
    assert (order[1:] == order[:-1]).mean() > 0.4   # by chance: an eighth


# ------------------------------------------------------------------ language model

def brute_scores(rows, order, least):
    texts = [re.findall("[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for _, t in rows]
    counts = Counter(tuple(w[i : i + n]) for w in texts for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(map(len, texts))
    out = Counter()
    for (k, _), w in zip(rows, texts):
        score, backs = 0.0, 0
        for i in range(len(w)):
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(w[i - n + 1 : i + 1])
                if n == 1 or counts[gram] >= least:
                    score += math.log(counts[gram] / (total if n == 1 else counts[gram[:-1]]))
                    break
                score += math.log(0.4)
                backs += 1
        out[(k, len(w), round(score, 4), backs)] += 1
    return out


@pytest.mark.parametrize("order,least", [(2, 2), (3, 2), (1, 1), (4, 2), (4, 3)])
def test_backoff_scores_match_brute_force(docs, order, least):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = Counter((r.doc_id, r.n_words, round(r.log_score, 4), r.n_backoffs)
                  for r in backoff_lm.backoff_scores(docs, order, least).collect())
    assert got == brute_scores(rows, order, least)


def test_backoff_edges(odd, none):
    rows = backoff_lm.backoff_scores(odd).collect()
    got = Counter((r.doc_id, r.n_words, round(r.log_score, 4), r.n_backoffs) for r in rows)
    assert got == brute_scores(ODD, 2, 2)
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in rows)
    assert backoff_lm.backoff_scores(none).count() == 0


def test_a_registered_query_scores_trigrams(llm, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = queries.QUERIES["op9_backoff_lm_order3"](llm, "/root/testdata/sf0.001").collect()
    got = Counter((r.doc_id, r.n_words, round(r.log_score, 4), r.n_backoffs) for r in found)
    assert got == brute_scores(rows, 3, 2) != brute_scores(rows, 2, 2)


# ------------------------------------------------------------------ SentencePiece

STRANGE = ["", "a  b   c", " lead", "trail  ", "x\n\n y\t", "日本語 é", "a" * 300, "ab" * 100 + " c", "Ａ<s> </s>", "   ", "é", "<0x41>"]


def test_encoding_equals_the_library(docs):
    from sentencepiece import SentencePieceProcessor
    sp, m = SentencePieceProcessor(model_file=PIECES), sp_viterbi.model(PIECES)
    texts = STRANGE + [r.text for r in docs.select("text").collect()]
    ids, bounds = m.encode(pa.array(texts))
    back = m.decode(ids, bounds)
    for i, t in enumerate(texts):
        own = ids[bounds[i] : bounds[i + 1]].tolist()
        assert own == sp.encode(t) and back[i] == sp.decode(own) == t


def test_viterbi_finds_the_best_path():
    m = sp_viterbi.SentencePieces(PIECES, "unigram")
    rnd = np.random.default_rng(2)
    m.scores = -rnd.random(len(m.scores)) * 10 - 1
    m.least = m.scores.min()
    score = {}
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=PIECES)
    for p, s in zip(m.piece, m.scores):
        score[sp.id_to_piece(int(p)).replace("▁", " ")] = s
    words = [" these", " words", " are", " segmented", " unbelievably", " é日x", " aaaaaaa"]
    for w in words:
        best = [0.0] + [-math.inf] * len(w)
        for j in range(1, len(w) + 1):
            for i in range(max(0, j - 20), j):
                gain = score.get(w[i:j], m.least - 10 if j == i + 1 else -math.inf)
                best[j] = max(best[j], best[i] + gain)
        data = np.frombuffer(w.encode(), np.uint8)
        ids, _ = m.encode_units(data, np.array([0]), np.array([len(data)]))
        text = m.decode(ids, np.array([0, len(ids)]))[0]
        assert " " + text == w
        by_piece = sum(score.get(sp.id_to_piece(int(i)).replace("▁", " "), 0.0) for i in ids if not sp.is_byte(int(i)))
        unknown = sum(1 for c in w if c not in score)
        assert by_piece + unknown * (m.least - 10) == pytest.approx(best[-1])


def test_round_trips(odd, none):
    rows = sp_viterbi.round_trips(odd, PIECES).collect()
    assert len(rows) == len(ODD)
    assert {r.doc_id for r in rows if not r.round_trip} == {10}   # a literal U+2581 is a space to the model
    assert sp_viterbi.round_trips(none, PIECES).count() == 0
    texts = {r.doc_id: r.text for r in sp_viterbi.decoded(sp_viterbi.encoded(odd, PIECES), PIECES).collect() if r.doc_id in (4, 8, 11)}
    assert texts == {k: t for k, t in ODD if k in (4, 8, 11)}


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(llm):
    import corpus_pipeline as P
    from keelson.llm.packed import stored
    from tests.llm.test_llm_dedup import brute_components, brute_repeats

    sf = "/root/testdata/sf0.001"
    docs = [llm.read.parquet(f"{sf}/documents.parquet")]
    for name, stage in P.STAGES:
        docs.append(stored(stage(llm, docs[-1], sf), "stage"))
    start, ruled, classed, single, cut, pieces = docs
    for before, after in ((start, ruled), (ruled, classed), (classed, single), (single, cut)):
        assert after.columns == P.COLUMNS and after.dtypes == before.select(*P.COLUMNS).dtypes
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    labels = {r.doc_id: r for r in llm.read.parquet(f"{sf}/labels.parquet").collect()}
    assert not [i for i in ids(ruled) if i in labels and labels[i].quality == 0 and len(ids(ruled)) < 100]
    rows = [(r.doc_id, r.text) for r in classed.collect()]
    assert ids(single) == {k for (k, _, c), _ in brute_components(rows).items() if k == c}
    before = {r.doc_id: r.text for r in single.collect()}
    want = {k: n for (k, _, n, _, _), _ in brute_repeats(list(before.items())).items()}
    for r in cut.collect():
        lost = len(before[r.doc_id].encode()) - len(r.text.encode())
        assert lost <= want[r.doc_id] <= lost + 8 * 6 and r.n_chars == len(r.text)
    assert ids(pieces) == ids(cut) == ids(single)
    ran = P.run(llm, sf)
    assert ran.count() == pieces.count()


def test_entry_works_without_the_package(tmp_path):
    """The registry must import, and keep its own queries, when this package is gone."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path
    root = Path(__file__).resolve().parents[2]
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "keelson", tmp_path / "keelson", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pagerank' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"} | {
        k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})
