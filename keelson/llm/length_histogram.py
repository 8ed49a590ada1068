"""Token counts: exact length histogram with suffix sums.

Documents are aggregated by encoded length. Suffix sums over the lengths
answer, for every context limit, how many documents and tokens exceed it, how
many tokens are left when each document is truncated to it, and which quantile
a length is. The histogram has one row a distinct length; the sums run within
blocks of ``BLOCK`` lengths, and one sum a block is carried over.

Edge cases: a null or empty text has length 0. Equal texts and repeated rows
count each. Texts are encoded whole, whatever their length. An empty table
gives an empty histogram. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.packed import stored
from keelson.llm.textbytes import pieces
from keelson.llm.tokens import STEP_BYTES, encoder

#: Lengths in a block of the suffix sums.
BLOCK = 1024


def token_lengths(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """``n_tokens`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        for b in pieces(batches, text_col, STEP_BYTES):
            _, bounds = encode(b.column(text_col))
            yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(np.diff(bounds), pa.int64())})

    return docs.select(text_col).mapInArrow(run, "n_tokens bigint")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row a distinct ``n_tokens``: counts, suffix sums and the limit's answers.

    ``n_docs``, ``tokens``: of this length. ``docs_over``, ``tokens_over``: of
    greater lengths. ``docs_to``: of this length or less; ``quantile``: their
    share. ``truncated_tokens``: all tokens when each document keeps at most
    this many.
    """
    # stored: a row a length, read three times below; the texts are encoded once
    counts = stored(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")).withColumns({
        "tokens": F.col("n_docs") * F.col("n_tokens"), "block": F.floor(F.col("n_tokens") / BLOCK)}), "lengths")
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # a row a block of lengths: a few, bounded by the longest text
    blocks = counts.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_later"),
                           F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_later"))
    total = counts.agg(F.sum("n_docs").alias("all_docs"), F.sum("tokens").alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return (counts.withColumns({"d": F.coalesce(F.sum("n_docs").over(inside), F.lit(0)),
                                "t": F.coalesce(F.sum("tokens").over(inside), F.lit(0))})
            .join(blocks, "block").join(F.broadcast(total))
            .withColumns({"docs_over": F.col("d") + F.col("docs_later"), "tokens_over": F.col("t") + F.col("tokens_later")})
            .select("n_tokens", "n_docs", "tokens", "docs_over", "tokens_over",
                    (F.col("all_docs") - F.col("docs_over")).alias("docs_to"),
                    ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("quantile"),
                    (F.col("all_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("truncated_tokens")))


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """The answers for any context limits (``limit``): docs_over, tokens_over and truncated_tokens."""
    longer = F.col("n_tokens") > F.col("limit")
    asked = histogram.sparkSession.createDataFrame([(int(x),) for x in limits], "`limit` bigint")
    # the histogram's rows meet the few limits: a stated query set
    return histogram.join(F.broadcast(asked)).groupBy("limit").agg(
        F.coalesce(F.sum(F.when(longer, F.col("n_docs"))), F.lit(0)).alias("docs_over"),
        F.coalesce(F.sum(F.when(longer, F.col("tokens"))), F.lit(0)).alias("tokens_over"),
        F.sum(F.col("n_docs") * F.least("n_tokens", "limit")).alias("truncated_tokens"))


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """The least length whose ``quantile`` reaches each share."""
    asked = histogram.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    return histogram.join(F.broadcast(asked), F.col("quantile") >= F.col("share")).groupBy("share").agg(
        F.min("n_tokens").alias("n_tokens"))
