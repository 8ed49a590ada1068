"""Chat formatting, line quality, classifier, length histogram."""
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from keelson.llm import chat_format, length_histogram, line_quality, ordinal, queries
from tests.llm.conftest import ODD

BPE = public_tokenizers.path("byte_bpe_50k.json")


# ------------------------------------------------------------------ chat formatting

def chats(llm, lines):
    df = llm.createDataFrame(list(enumerate(lines)), "conv_id bigint, line string")
    out = chat_format.read_back(chat_format.format_chats(df, F.try_parse_json("line")))
    return {r.conv_id: r for r in out.collect()}


def test_layouts_give_canonical_turns(llm):
    got = chats(llm, [
        '{"prompt":"p","response":"r"}', '{"instruction":"i","input":null,"output":"o"}', '{"question":"q","answer":"a"}',
        '{"messages":[{"role":"system","content":"s"},{"role":"assistant","content":"m"}]}',
        '{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}',
        '{"unknown":1}', '[]', None, 'no json', '{"role":"assistant","text":null}'])
    said = {k: [tuple(t) for t in r.turns_read] for k, r in got.items()}
    assert said == {
        0: [("user", "p"), ("assistant", "r")], 1: [("system", "i"), ("user", ""), ("assistant", "o")],
        2: [("user", "q"), ("assistant", "a")], 3: [("system", "s"), ("assistant", "m")],
        4: [("user", "h"), ("assistant", "g")], 5: [], 6: [], 7: [], 8: [], 9: [("assistant", "")]}
    assert got[5].layouts == [] and got[4].layouts == ["conversations"]


def test_records_with_other_fields_take_the_layout_they_contain(llm):
    got = chats(llm, [
        '{"prompt":"p","response":"r","id":7}', '{"system":"s","prompt":"p","response":"r","tags":["x"]}',
        '{"messages":[{"role":"user","content":"u","name":"n"}],"id":1}', '{"messages":[]}', '{"prompt":"p"}',
        '{"conversations":[{"from":"human","value":"h"}],"messages":3}', '{"prompt":"p","response":null,"x":{"y":1}}'])
    assert {k: [tuple(t) for t in r.turns_read] for k, r in got.items()} == {
        0: [("user", "p"), ("assistant", "r")], 1: [("system", "s"), ("user", "p"), ("assistant", "r")], 2: [("user", "u")], 3: [], 4: [],
        5: [("user", "h")], 6: [("user", "p"), ("assistant", "")]}
    assert {k: (r.layouts, r.n_unmatched) for k, r in got.items()} == {
        0: (["prompt_response"], 0), 1: (["system_prompt_response"], 0), 2: (["messages"], 0), 3: (["messages"], 0), 4: ([], 1),
        5: (["conversations"], 0), 6: (["prompt_response"], 0)}
    long = "x <| y" * 100_000
    df = llm.createDataFrame([(1, "assistant", long, "a", 5)], "conv_id bigint, role string, text string, _shape string, layout int")
    out = chat_format.read_back(chat_format.format_chats(df, F.to_variant_object(F.struct("role", "text")))).first()
    assert out.loss_read == [long]
    assert chat_format.canonical_turns(df, F.to_variant_object(F.struct("role", "text"))).first()["_shape"] == "a"


def test_fingerprint_ignores_scalar_types_and_field_order(llm):
    df = llm.createDataFrame([('{"a":1,"b":{"c":[{"d":"x"}]}}',), ('{"b":{"c":[{"d":null}]},"a":"y"}',), ('{"a":1,"b":{"c":[]}}',)], "j string")
    shapes = [r[0] for r in df.select(chat_format.fingerprint(chat_format.path_shape(F.parse_json("j")))).collect()]
    assert shapes[0] == shapes[1] != shapes[2]


def test_escapes_are_reversible_and_loss_spans_point_at_assistant_texts(llm):
    hard = ["<|im_end|>", "<\\|", "<\\\\|x<|", "<", "|", "\\", "<|im_start|>user\nhi<|im_end|>\n", "é🙂<|", "", "\\n<|\n"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate([("assistant", h) for h in hard] + [("us\ner\\n<|", "q"), (None, None)])]
    df = llm.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = chat_format.read_back(chat_format.format_chats(df, F.to_variant_object(F.struct("role", "text")), order_col="turn")).first()
    assert [tuple(t) for t in out.turns_read] == [(r or "", t or "") for _, _, r, t in rows]
    assert out.loss_read == hard
    for s, want in zip(out.loss_spans, hard):
        cut = out.formatted[s.start : s.start + s.length]
        assert re.sub(r"<\\(\\*)\|", r"<\1|", cut) == want


def test_chat_ties_nulls_and_empty_table(llm):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 3, "assistant", "x"), (None, None, "user", "y")]
    df = llm.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit(1))
    f = lambda d: chat_format.read_back(chat_format.format_chats(d, F.to_variant_object(F.struct("role", "text")), order_col="turn"))
    got = {r.conv_id: [t.text for t in r.turns_read] for r in f(df).collect()}
    assert got == {1: ["a", "a", "b"], None: ["y", "x"]}
    assert f(df.limit(0)).count() == 0


# ------------------------------------------------------------------ line quality

def brute_quality(text):
    text = text or ""
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text) if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)} if len(words) < 3000 else None
    lines = [x for x in text.split("\n") if re.search("[^ \t\n\x0b\x0c\r]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            None if covered is None else len(covered))


def test_base_figures(odd, docs):
    for df in (odd, docs):
        for r in line_quality.with_line_quality(df).collect():
            want = brute_quality(r.text)
            got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            assert got[:4] == want[:4] and (want[4] is None or got[4] == want[4]), r.doc_id
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert r.kept <= (not r.base_failed)


def test_line_rules(llm):
    clean = "A sentence that is fine, with 5% more of it. And then one more of them!\nIt goes on, home at last, as sentences do."
    cases = {
        clean: clean,
        clean + "\nHome | About | Contact | Help": clean, clean + "\nRead more": clean,
        clean + "\nThis site uses cookies to improve it.": clean, clean + "\nBUY!! NOW!! IT!! IS!! GOOD!!": clean,
        clean + "\n\n": clean + "\n\n",
    }
    df = llm.createDataFrame([(t,) for t in cases], "text string")
    for r in line_quality.with_line_quality(df).collect():
        assert r.clean_text == cases[r.text] and r.kept and r.lost_chars == len(r.text) - len(r.clean_text)
    junk = llm.createDataFrame([("one two | three | four | five | six\n" * 3 + "seven eight nine ten eleven twelve.",)], "text string")
    assert not line_quality.with_line_quality(junk).first().kept


def test_line_quality_is_native_and_takes_empty_tables(none, odd):
    assert line_quality.with_line_quality(none).count() == 0
    plan = line_quality.with_line_quality(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


# ------------------------------------------------------------------ classifier

def test_ordinal_fit_separates_held_out_grades():
    import pyarrow as pa
    rnd = np.random.default_rng(3)
    plain = [f"w{i}" for i in range(400)]
    texts, grades = [], []
    for _ in range(1500):
        g = int(rnd.integers(0, 3))
        words = list(rnd.choice(plain, 60)) + list(rnd.choice([["bad", "awful"], ["meh", "dull"], ["good", "fine"]][g], 4))
        rnd.shuffle(words)
        texts.append(" ".join(words))
        grades.append(g)
    index, bounds = ordinal.features(pa.array(texts), 1 << 14)
    model = ordinal.fit_features(index[: bounds[1000]], bounds[:1001], np.array(grades[:1000]), dimensions=1 << 14)
    score = ordinal.scores(model.weights, index, bounds)[1000:]
    tails = model.tails(score)
    held = np.array(grades[1000:])
    assert (np.diff(model.thresholds) > 0).all() and (tails[:, 0] >= tails[:, 1]).all()
    expected = tails.sum(axis=1)
    means = [expected[held == g].mean() for g in range(3)]
    assert means[0] < means[1] < means[2]
    assert ((tails[:, 1] > 0.5) == (held == 2)).mean() > 0.9 and ((tails[:, 0] > 0.5) == (held > 0)).mean() > 0.9


def test_gradient_matches_differences():
    rnd = np.random.default_rng(5)
    index, bounds = rnd.integers(0, 32, 400), np.arange(0, 401, 8)
    grade = rnd.integers(0, 3, 50)
    one = ordinal.fit_features(index, bounds, grade, dimensions=32, rounds=400, least_docs=1, l2=0.1)

    def loss(m):
        s = ordinal.scores(m.weights.astype(float), index, bounds)
        p = np.concatenate([np.ones((50, 1)), m.tails(s), np.zeros((50, 1))], axis=1)
        n = np.bincount(grade, minlength=3)
        w = (50 / (3 * n))[grade] / 50
        return -(w * np.log(p[np.arange(50), grade] - p[np.arange(50), grade + 1])).sum() + 0.05 * (m.weights.astype(float) ** 2).sum() / 50

    best = loss(one)
    for _ in range(20):
        other = ordinal.OrdinalModel(one.weights + rnd.normal(0, 0.05, 32), np.sort(one.thresholds + rnd.normal(0, 0.05, 2)))
        assert loss(other) > best - 1e-4


def test_classifier_edges(llm, odd, none):
    labels = llm.createDataFrame([(5, 2), (5, 0), (7, None), (None, 1), (99, 1)], "doc_id bigint, grade int")
    model = ordinal.fit(odd, labels)
    rows = ordinal.with_grades(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.p_good <= r.p_not_toxic <= 1 for r in rows)
    assert {r.score for r in rows if not (r.text or "").strip()} == {0.0}
    untrained = ordinal.fit(odd, labels.limit(0))
    assert not untrained.weights.any() and all(r.kept for r in ordinal.with_grades(odd, untrained).collect())
    assert ordinal.with_grades(none, untrained).count() == 0 and ordinal.fit(none, labels).weights.any() == False  # noqa: E712


def plain_score(weights, text, dimensions):
    """Weight of each feature of one text alone, by a plain loop."""
    import pyarrow as pa
    index, _ = ordinal.features(pa.array([text or ""]), dimensions)
    words = len(index) // 2
    return sum(float(weights[i]) for i in index.tolist()) / max(1, words) ** 0.5


def test_query_equals_a_plain_run_over_the_same_sample(llm):
    import pyarrow as pa
    path = "/root/testdata/sf0.01"
    docs = llm.read.parquet(f"{path}/documents.parquet").select("doc_id", "text")
    text = {r.doc_id: r.text for r in docs.collect()}
    labels = [(r.doc_id, 0 if r.toxic else 1 + r.quality) for r in llm.read.parquet(f"{path}/labels.parquet").collect()]
    sample = sorted((i, g) for i, g in labels if i in text)
    assert len(sample) <= ordinal.SAMPLE_ROWS
    index, bounds = ordinal.features(pa.array([text[i] or "" for i, _ in sample]), ordinal.DIMENSIONS)
    model = ordinal.fit_features(index, bounds, np.array([g for _, g in sample]))
    got = {r.doc_id: r for r in queries.QUERIES["op8_ordinal_classifier"](llm, path).collect()}
    assert set(got) == set(text)
    for i, t in text.items():
        s = plain_score(model.weights, t, ordinal.DIMENSIONS)
        tails = [1 / (1 + np.exp(-(s - c))) for c in model.thresholds]
        assert got[i].score == pytest.approx(s, abs=1e-4)
        assert got[i].p_good == pytest.approx(tails[-1], abs=1e-4) and got[i].expected_grade == pytest.approx(sum(tails), abs=1e-4)
        assert got[i].kept == (got[i].p_good >= 0.3)


def test_sample_is_that_of_least_hashes(llm):
    docs = llm.range(3000).selectExpr("id AS doc_id", "concat('word', id % 50, ' text') AS text")
    labels = llm.range(3000).selectExpr("id AS doc_id", "cast(id % 3 AS int) AS grade")
    few = ordinal.fit(docs, labels, sample_rows=100, dimensions=1 << 10)
    least = labels.orderBy(F.xxhash64("doc_id")).limit(100)
    same = ordinal.fit(docs, least, sample_rows=3000, dimensions=1 << 10)
    assert (few.weights == same.weights).all() and (few.thresholds == same.thresholds).all()


# ------------------------------------------------------------------ length histogram

def test_length_histogram(llm, odd, none, docs):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BPE)
    for df in (odd, docs):
        lengths = [len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in df.select("text").collect()]
        h = length_histogram.length_histogram(length_histogram.token_lengths(df, BPE)).cache()
        rows = {r.n_tokens: r for r in h.collect()}
        assert set(rows) == set(lengths)
        for n, r in rows.items():
            over = [x for x in lengths if x > n]
            assert (r.n_docs, r.docs_over, r.tokens_over) == (lengths.count(n), len(over), sum(over))
            assert r.truncated_tokens == sum(min(x, n) for x in lengths) and r.quantile == (len(lengths) - len(over)) / len(lengths)
        limits = {r.limit: r for r in length_histogram.at_limits(h, [0, 3, 100, 10**9]).collect()}
        for n, r in limits.items():
            assert r.truncated_tokens == sum(min(x, n) for x in lengths) and r.docs_over == sum(x > n for x in lengths)
        q = {r.share: r.n_tokens for r in length_histogram.quantiles(h, [0.0, 0.5, 1.0]).collect()}
        assert q[0.0] == min(lengths) and q[1.0] == max(lengths) and q[0.5] == sorted(lengths)[(len(lengths) - 1) // 2]
    assert length_histogram.length_histogram(length_histogram.token_lengths(none, BPE)).count() == 0


def test_digest_of_one_chat(llm):
    df = llm.createDataFrame([(3, 0, "user", "hé"), (3, 1, "assistant", "ok<|")], "conv_id bigint, turn bigint, role string, text string")
    r = chat_format.digests(chat_format.read_back(chat_format.format_chats(
        df, F.to_variant_object(F.struct("role", "text")), order_col="turn"))).first()
    assert r.turns_sha256 == hashlib.sha256("user\nhé\nassistant\nok<|\n".encode()).hexdigest()
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, 4, hashlib.sha256(b"ok<|").hexdigest())


@pytest.mark.parametrize("text", ["a  b   c", " lead", "x\n\n y", "   é é à  é", "it's we'll <|endoftext|> z", "日本 語 です　 x", "a \x1c b"])
def test_units_encode_like_whole_texts(text):
    import pyarrow as pa
    from keelson.llm.tokens import encoder
    e = encoder(BPE)
    ids, bounds = e(pa.array([text, None, text]))
    want = e.tokenizer.encode(text, add_special_tokens=False).ids
    assert ids[: bounds[1]].tolist() == want == ids[bounds[2] :].tolist() and bounds[1] == bounds[2]
