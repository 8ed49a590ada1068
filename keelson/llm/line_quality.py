r"""Line-first cleaning (DataFrame functions only).

Each ``\n``-separated line is judged on its own by punctuation, navigation and
boilerplate rules; failing lines are removed, and a document that loses too
much of its text is rejected. Base figures (words, symbols, repeated lines and
5-word windows) are computed beside it over the whole text.

Rules of a line that has a word (lines without one are kept as they are):

* punctuation: of its words, more than ``max_symbol_words`` end in or consist
  of symbols (``#*$%&|<>``) or doubled ``!``/``?``;
* navigation: at least 3 separators (`` | ``, `` > ``, `` » ``, `` · ``) and at
  most 4 words for each part on average; or one to three words of a fixed
  navigation list and nothing else;
* boilerplate: it starts with or consists of a fixed boilerplate phrase
  (cookie, script, subscription and sharing notices).

Edge cases: a null or empty text has no words, all figures 0, fails the base
rule and is rejected; its clean text is empty. Ties and repeated rows are
judged independently (the work is row by row, without a shuffle). Extra
columns are kept; a result column replaces an input column of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[ \t\n\x0B\f\r]+"
NOT_SPACE = r"[^ \t\n\x0B\f\r]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10

# Navigation words and boilerplate phrases (lower case).
NAVIGATION = ["home", "menu", "search", "login", "log in", "sign in", "sign up", "register", "next", "previous",
              "back", "back to top", "top", "contact", "contact us", "about", "about us", "sitemap", "help", "faq",
              "share", "tweet", "print", "download", "read more", "more", "continue reading", "skip to content"]
BOILERPLATE = [r"(this (web)?site uses|we use|accept( all)?) cookies", r"cookie (policy|settings)",
               r"(please )?enable javascript", r"javascript (is|must be) ", r"subscribe to (our|the) newsletter",
               r"(click|tap) here to ", r"share (this|on) (page|article|post|facebook|twitter)",
               r"sign up for (our|the) ", r"terms (of use|of service|and conditions) ?(\||\z)", r"privacy policy ?(\||\z)"]

_SYMBOL_WORD = r"([#*$%&|<>~^=_]+|[!?]{2,})\z"
_NAV = r"^\W*((" + "|".join(NAVIGATION) + r")\W*){1,3}\z"
_BOILER = r"^\W*(" + "|".join(BOILERPLATE) + ")"


def split_words(text: Column) -> Column:
    """Words of a text, an empty array if there are none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row (a lambda argument), however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_window_words(words: Column) -> Column:
    """Words covered by 5-word windows that occur at least twice in the array.

    Windows are compared by a 64-bit hash of five 64-bit word hashes; the
    starts of repeated ones are found by sorting (hash, start).
    """
    def windows(hashes: Column) -> Column:
        return F.transform(F.slice(hashes, F.lit(1), F.size(hashes) - (WINDOW - 1)),
                           lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]))

    def gaps(starts: Column) -> Column:
        """Words newly covered by each start: up to the next start, 5 at most."""
        return F.transform(starts, lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - s, F.lit(WINDOW))))

    def repeated(order: Column) -> Column:
        return F.filter(order, lambda x, i: ((i > 0) & (F.get(order, i - 1)["h"] == x["h"]))
                        | ((i + 1 < F.size(order)) & (F.get(order, i + 1)["h"] == x["h"])))

    def covered(w: Column) -> Column:
        order = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = F.sort_array(F.transform(bind(order, repeated), lambda x: x["i"]))
        return F.aggregate(bind(starts, gaps), F.lit(0).cast("long"), lambda a, x: a + x)

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w))

    counted = bind(bind(F.transform(words, lambda w: F.xxhash64(w)), windows), count)
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(counted)


def _fails(line: Column, max_symbol_words: float) -> Column:
    words = F.filter(F.split(line, SPACES), lambda w: w != "")
    symbol = F.size(F.filter(words, lambda w: w.rlike(_SYMBOL_WORD)))
    parts = F.size(F.split(line, r" [|>»·] ")) - 1
    low = F.lower(line)
    return (line.rlike(r"[#*$%&|<>~^=_]|[!?]{2}") & (symbol > F.lit(max_symbol_words) * F.size(words))) \
        | (line.rlike(r" [|>»·] ") & (parts >= 3) & (F.size(words) <= 4 * (parts + 1) + parts)) \
        | ((F.length(line) <= 60) & low.rlike(_NAV)) | low.rlike(_BOILER)


def with_line_quality(df: DataFrame, text_col: str = "text", max_symbol_words: float = 0.2,
                      max_lost: float = 0.3) -> DataFrame:
    """``df`` plus base figures, ``clean_text``, ``lost_chars`` and the verdict ``kept``.

    ``kept`` is false if the base rule fails (fewer than 10 words, or over 20 %
    of them in repeated 5-word windows), or if the removed lines hold more than
    ``max_lost`` of the text's code points.
    """
    # The costly values stand in one struct column of their own projection:
    # the optimizer doesn't repeat a costly expression that is read twice.
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n")
    word_lines = F.filter(lines, lambda x: x.rlike(NOT_SPACE))
    base = bind(split_words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_window_words(w).alias("n_repeat_words")))
    dup = bind(word_lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long"))
    clean = F.array_join(F.filter(lines, lambda x: ~(x.rlike(NOT_SPACE) & _fails(x, max_symbol_words))), "\n")
    out = (df.withColumn("_q", F.struct(base.alias("b"), dup.alias("d"), clean.alias("c")))
           .withColumns({
               "n_words": F.col("_q.b.n_words"), "word_chars": F.col("_q.b.word_chars"),
               "n_symbols": (F.size(F.split(text, SYMBOLS)) - 1).cast("long"),
               "n_dup_lines": F.col("_q.d"), "n_repeat_words": F.col("_q.b.n_repeat_words"),
               "lost_chars": (F.length(text) - F.length("_q.c")).cast("long"),
               "clean_text": F.col("_q.c")}))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (
        F.col("lost_chars") <= F.lit(max_lost) * F.length(text))).drop("_q")
