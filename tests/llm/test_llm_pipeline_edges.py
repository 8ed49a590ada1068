"""Each stage of the pipeline on odd rows, clashing columns and an empty table."""
import pytest

import corpus_pipeline
from tests.llm.conftest import LONG, ODD, SAME

PATH = "/root/testdata/sf0.001"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_empty_tables(llm, odd, none, name):
    out = stage(name)(llm, odd, PATH)
    if name != "packing":
        assert out.columns == corpus_pipeline.COLUMNS
    rows = out.collect()
    assert stage(name)(llm, none, PATH).count() == 0
    given = sorted((i is None, i or 0, t or "") for i, t in ODD)
    if name == "quality rules":
        assert all((r.text or "").strip() and r.n_chars == len(r.text) for r in rows)
    elif name == "quality classifier":
        assert {(r.doc_id, r.text) for r in rows} <= set(ODD)
    elif name == "near duplicates":
        same = [r for r in rows if r.text == SAME]
        assert [r.doc_id for r in same] == [5] and sum(r.text == LONG for r in rows) == 1
        assert sum(not (r.text or "").split() for r in rows) == sum(not (t or "").split() for _, t in ODD)
    elif name == "repeated passages":
        assert len(rows) == len(ODD)
        assert {r.text for r in rows if r.doc_id == 5} == {SAME} and all(r.n_chars == len(r.text) for r in rows)
        assert {r.text for r in rows if r.doc_id in (6, 9)} == {""}
    else:
        tokens = {}
        for r in rows:
            tokens.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert all(sum(n for _, n in x) <= 2048 for x in tokens.values())
        assert sum(r.start == 0 for r in rows) == len(given)
