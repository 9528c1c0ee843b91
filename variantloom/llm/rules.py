"""Quality rules, line first, in DataFrame operations alone.

Each line is judged by punctuation, navigation and boilerplate rules and removed where it fails; a document that loses too
much of its text is rejected, as is one that fails the base rules. Everything is computed row by row, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

SPLIT = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_KEPT = 0.5
#: Lines with two bars, or with arrows between items, are navigation.
NAVIGATION = "\\|.*\\||\\|\\s*$|».*»| > .* > "
#: Runs of marks, or words that all shout.
PUNCTUATION = "[#*$%&]{3}|!!.*!!"
BOILERPLATE = "(?i)all rights reserved|terms of (use|service)|privacy policy|accept (all )?cookies|licen[sc]ed under|released under the|lorem ipsum|click here|javascript must be enabled"


def let(value: Column, body) -> Column:
    """body(value), with value computed once: an expression inside a lambda would be computed for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, SPLIT), "")


def bad_line(line: Column) -> Column:
    return line.rlike(NAVIGATION) | line.rlike(PUNCTUATION) | line.rlike(BOILERPLATE)


def solid_chars(text: Column) -> Column:
    return F.char_length(F.translate(text, C.SPACES, ""))


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of so many words found twice or more, the first one included."""
    def covered(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.struct(F.xxhash64(F.slice(w, i, window)).alias("h"), i.alias("i")))
        return F.when(F.size(w) < window, 0).otherwise(let(grams, among))

    def among(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(F.transform(g, lambda x: x["h"]))) == F.size(g), 0).otherwise(let(F.array_sort(g), lambda s: let(F.array_sort(places(s)), cover)))

    def places(s: Column) -> Column:
        near = lambda k, x: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        marked = F.transform(s, lambda x, k: F.when(near(k - 1, x) | near(k + 1, x), x["i"]))
        return F.filter(marked, lambda i: i.isNotNull())

    def cover(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda i, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - i, F.lit(window)))), F.lit(0), lambda a, x: a + x)

    return let(words, covered)


def judge(docs: DataFrame, least_kept: float = LEAST_KEPT) -> DataFrame:
    """Every row of (doc_id, text) with its counts, base verdict, final verdict and the cleaned text.

    A null or empty text has no words and fails the base rules. Repeated rows and null ids are judged each; other columns
    are not read; an empty table gives no rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counted = rows.select(
        "doc_id", solid_chars(F.col("text")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(word_list(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).cast("long").alias("again"))).alias("w"),
        let(lines, lambda v: F.struct((F.size(v) - F.size(F.array_distinct(v))).cast("long").alias("dup"), F.array_join(F.filter(v, lambda x: ~bad_line(x)), "\n").alias("clean"))).alias("l"),
    )
    failed = (F.col("w.n") < 10) | (100 * F.col("w.again") > 20 * F.col("w.n"))
    return counted.select(
        "doc_id", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", F.col("l.dup").alias("n_dup_lines"), F.col("w.again").alias("n_repeat_words"),
        failed.alias("base_failed"), (~failed & (solid_chars(F.col("l.clean")) >= least_kept * F.col("word_chars"))).alias("kept"), F.col("l.clean").alias("text"))
