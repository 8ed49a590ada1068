"""LM scoring: stupid-backoff scores over n-gram counts of the whole corpus.

The n-gram count table is partitioned by hash: every block of documents sends
its distinct n-grams with their counts, a bucket sums them, and the totals
come back to the blocks that asked, where they are joined to each position's
n-grams and summed per document. Words and pairs go first. A longer n-gram is
only sent, order by order, if both n-grams of one word less occur
``least_count`` times: else it doesn't either, and no score asks for it.

    S(w | h) = c(h w) / c(h)             if c(h w) >= least_count
             = ALPHA * S(w | shorter h)  otherwise;  S(w) = c(w) / N

``c(h)`` counts all occurrences of h in its text, and a word's history never
leaves its text: the first word has none, and so pays no backoff. Words are the
runs of non-space bytes, A-Z lowered. N, the number of all words, is the count
of the empty n-gram.

Every block sends a key once, so a word pair that stands in a third of all
documents costs one row part a block. Counts cover all documents.

Edge cases: a null, empty or blank text has 0 words, log score 0 and a null
mean. Texts of any length are one unit of a block. Repeated rows count and are
scored each. An empty table gives an empty table; extra columns are ignored. N-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.packed import bucket_count, counted_keys, key_totals, pack, stored, with_replies
from keelson.llm.textbytes import SpanHash, flat, lower_ascii, mix, words

# Fixed value: the published backoff factor.
ALPHA = 0.4
ORDER, LEAST_COUNT = 2, 2
#: Orders up to this one are counted in one exchange; each higher one in its own, after the one before.
FIRST = 2


def ngrams(texts: pa.Array, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Per order 0 .. ``order``, each word position's n-gram hash (ending there), and the texts' bounds.

    A position with too short a history has 0 at that order.
    """
    data, offsets = flat(texts)
    data = lower_ascii(data)
    start, end, bounds = words(data, offsets)
    w = SpanHash(data)(start, end)
    place = np.arange(len(w)) - np.repeat(bounds[:-1], np.diff(bounds))
    out = [np.full(len(w), mix(np.array([0x3C79AC492BA7B653], np.uint64))[0])]
    h = np.zeros(len(w), np.uint64)
    for n in range(1, order + 1):
        # the n-gram's hash from its last word back to its first
        back = np.concatenate([np.zeros(n - 1, np.uint64), w[: len(w) - n + 1]])[: len(w)]
        h = h * np.uint64(0x9FB21C651E98DF25) + back
        out.append(np.where(place >= n - 1, mix(h ^ np.uint64(0x1B873593 * n)) | np.uint64(1), np.uint64(0)))
    return out, bounds


def _counts(grams: list[np.ndarray], upto: int, least: int, buckets: int, got: dict[int, bytes]) -> list[np.ndarray]:
    """Corpus totals of each position's n-grams, order by order; 0 where there is none or it wasn't worth sending."""
    out: list[np.ndarray] = []
    for step in range(max(1, upto - FIRST + 1)):
        orders = range(min(FIRST, upto) + 1) if step == 0 else [FIRST + step]
        sent = [grams[n] if step == 0 else _worth_sending(grams, out, n, least) for n in orders]
        every = np.concatenate(sent)
        h = np.unique(every[every != 0])
        total = key_totals(h, buckets, {k - step * buckets: v for k, v in got.items() if step * buckets <= k < (step + 1) * buckets})
        for keys in sent:
            there = keys != 0
            found = np.zeros(len(keys))
            found[there] = total[np.searchsorted(h, keys[there])]
            out.append(found)
    return out


def _worth_sending(grams: list[np.ndarray], totals: list[np.ndarray], n: int, least: int) -> np.ndarray:
    """The n-grams, 0 where one of its two shorter ones occurs fewer than ``least`` times: so does the n-gram, then."""
    enough = totals[n - 1] >= least
    before = np.concatenate([[False], enough[:-1]]) if len(enough) else enough
    return np.where(enough & before, grams[n], np.uint64(0))


def backoff_scores(docs: DataFrame, order: int = ORDER, least_count: int = LEAST_COUNT, id_col: str = "doc_id") -> DataFrame:
    """(id, ``n_words``, ``log_score``, ``mean_log_score``, ``n_backoffs``) of every row; natural logarithms."""
    blocks = pack(docs.select(id_col, "text"))
    buckets = bucket_count(blocks)

    def first(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate(ngrams(rows.column("text"), min(order, FIRST))[0])
        return np.unique(every[every != 0], return_counts=True)

    def longer(n: int):
        def count(rows: pa.RecordBatch, got: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
            grams, _ = ngrams(rows.column("text"), n)
            keys = _worth_sending(grams, _counts(grams, n - 1, least_count, buckets, got), n, least_count)
            return np.unique(keys[keys != 0], return_counts=True)
        return count

    totals = counted_keys(blocks, buckets, first)
    for n in range(FIRST + 1, order + 1):
        totals = stored(totals, "totals")  # asked by the next order's exchange, and again at the end
        more = counted_keys(blocks, buckets, longer(n), totals)
        totals = totals.unionByName(more.withColumn("bucket", F.col("bucket") + F.lit((n - FIRST) * buckets)))

    def score(part: int, number: int, rows: pa.RecordBatch, got: dict[int, bytes], block: dict) -> Iterator[pa.RecordBatch]:
        grams, bounds = ngrams(rows.column("text"), order)
        tables = _counts(grams, order, least_count, buckets, got)
        log, steps = np.full(len(grams[0]), -np.inf), np.zeros(len(grams[0]))
        longest = np.minimum(np.arange(len(grams[0])) - np.repeat(bounds[:-1], np.diff(bounds)) + 1, order)
        for n in range(order, 0, -1):
            before = np.concatenate([[0.0], tables[n - 1][:-1]]) if n > 1 else tables[0]
            use = np.isinf(log) & (longest >= n) & ((n == 1) | (tables[n] >= least_count))
            steps += np.isinf(log) & (longest >= n) & ~use
            log[use] = np.log(tables[n][use] / before[use]) + steps[use] * np.log(ALPHA)
        n_words = np.diff(bounds)
        backs = np.concatenate([[0.0], np.cumsum(steps)])[bounds]
        # summed text by text, so that a score doesn't depend on its neighbours
        each = np.add.reduceat(np.append(log, 0.0), bounds[:-1]) if len(n_words) else np.zeros(0)
        each = np.where(n_words > 0, each, 0.0)
        yield pa.RecordBatch.from_pydict({
            id_col: rows.column(id_col).cast(pa.int64()), "n_words": pa.array(n_words, pa.int64()),
            "log_score": pa.array(each), "mean_log_score": pa.array(each / np.maximum(1, n_words), mask=n_words == 0),
            "n_backoffs": pa.array(np.diff(backs).astype(np.int64))})

    schema = f"`{id_col}` bigint, n_words bigint, log_score double, mean_log_score double, n_backoffs bigint"
    return with_replies(blocks, totals, score, schema)
