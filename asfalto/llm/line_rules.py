"""Line-first cleaning: rules of punctuation, navigation and boilerplate for every line, then a verdict.

Lines end at \\n. A line without a word is left alone; one that a rule fails is taken out; a document
that loses too large a share of its word characters, or keeps too few words, is rejected. All of
it is SQL functions over a row: no shuffle, no Python. The time for a text of n words is n log n (its
three-word windows are sorted), and a text is held whole by its own task alone.

Null and empty texts have no words: zeros, rejected. Repeated rows and ids are judged row by row.
Columns that clash with the new ones are replaced in the result of `judged`; `clean` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asfalto.llm.batches import free_name

LEAST_WORDS = 50
MOST_REPEATED = 0.5  # of the words, those in three-word windows that occur twice or more
MOST_LOST = 0.3  # of the word characters, those in lines that fail
SHORT_LINE = 12  # words; shorter lines must end like a sentence
PHRASE_LINE = 40  # words; phrases fail only lines that are shorter

# A word of a text, the symbols that are counted, white space.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"

MARKS = r"[#*$%&|<>@~^=_{}\\]+"
CRIES = r"[!?]{2,}"
SEPARATORS = r"(^|[\x20\x09-\x0D])([|»›•·>/]|-+>|::)([\x20\x09-\x0D]|\z)"
ENDS = ".!?:;…。！？"  # a short line may close quotes and brackets after one of them
CLOSERS = "\"'”’»)]"
# in lower case, at the start of a word
PHRASES = (
    "(^|[^a-z])(all rights reserved|cookie|privacy policy|terms of (use|service)|terms and conditions|javascript"
    "|click here|read more|sign (in|up)|log ?in|subscribe|newsletter|share (this|on)|follow us|skip to"
    "|back to top|powered by|lorem ipsum|copyright|©)"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once a row however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def fails(line: Column) -> Column:
    """Name of the first rule that a line fails, null if it passes or has no word."""
    last = F.right(F.rtrim(line, F.lit(SPACES + CLOSERS)), F.lit(1))

    def verdict(n: Column) -> Column:
        return (
            F.when(n == 0, None)
            # navigation: entries between separators
            .when(_matches(line, SEPARATORS) * 8 >= n, "navigation")
            # symbols glued to words, as in tables, markup and noise
            .when(_matches(line, MARKS) * 5 > n, "symbols")
            # cries at every turn
            .when(_matches(line, CRIES) * 5 > n, "cries")
            .when((n < PHRASE_LINE) & F.lower(line).rlike(PHRASES), "boilerplate")
            # headings, menus and labels end without a mark
            .when((n < SHORT_LINE) & ~F.lit(ENDS).contains(last), "punctuation")
        )

    return let(_matches(line, WORD), verdict)


def kept_lines(text: Column) -> Column:
    return F.filter(_lines(text), lambda line: fails(line).isNull())


def _letters(text: Column) -> Column:
    """Code points of the words."""
    return F.length(F.translate(text, SPACES, "")).cast("long")


def _repeated(words: Column) -> Column:
    """Words in three-word windows found twice or more, each word once.

    Windows are sorted with their places, so equal ones are neighbours; the places of those with an
    equal neighbour then count three words each, less what they share with the place before.
    """
    def places(windows: Column) -> Column:
        def same(w: Column, other: Column) -> Column:
            # by field: comparing whole structs is many times slower
            return F.coalesce(
                (w["c"] == other["c"]) & (w["b"] == other["b"]) & (w["a"] == other["a"]), F.lit(False))

        def again(w: Column, j: Column) -> Column:
            return same(w, F.get(windows, j - 1)) | same(w, F.get(windows, j + 1))

        return F.sort_array(F.transform(F.filter(windows, again), lambda w: w["i"]))

    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda word, i: F.struct(
            word.alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"), i.alias("i")),
    )
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        let(F.sort_array(windows), places), start,
        lambda seen, p: F.struct(
            p.alias("last"), (seen["total"] + F.least(F.lit(3), p - seen["last"])).alias("total")),
        lambda seen: seen["total"],
    )


def measures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, left_words, left_chars.

    `left_` counts what the lines without failures hold. Null counts as empty.
    """
    text = F.coalesce(text, F.lit(""))

    def of(whole: Column) -> Column:
        lines = F.filter(_lines(whole), lambda line: line.rlike(WORD))
        left = F.array_join(kept_lines(whole), "\n")
        return F.struct(
            let(words_of(whole), lambda words: F.struct(
                F.size(words).cast("long").alias("n"), _repeated(words).alias("repeated"))).alias("words"),
            _letters(whole).alias("word_chars"),
            (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda some: (F.size(some) - F.size(F.array_distinct(some))).cast("long"))
            .alias("n_dup_lines"),
            let(left, lambda rest: F.struct(
                _matches(rest, WORD).cast("long").alias("words"), _letters(rest).alias("chars"))).alias("left"),
        )

    return let(text, of)


def judged(docs: DataFrame, most_lost: float = MOST_LOST, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost_chars.

    `base_failed`: under `least_words` words, or more than MOST_REPEATED of them repeated. `kept`: not so, and
    lines that pass hold `least_words` words and all but `most_lost` of the word characters.
    """
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), measures(F.col("text")).alias("m"))
    n, repeated = F.col("m.words.n"), F.col("m.words.repeated")
    failed = (n < least_words) | (repeated > MOST_REPEATED * n)
    lost = F.col("m.word_chars") - F.col("m.left.chars")
    passed = (F.col("m.left.words") >= least_words) & (lost <= most_lost * F.col("m.word_chars"))
    return found.select(
        "doc_id", n.alias("n_words"), F.col("m.word_chars").alias("word_chars"),
        F.col("m.n_symbols").alias("n_symbols"), F.col("m.n_dup_lines").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"), failed.alias("base_failed"), (~failed & passed).alias("kept"),
        lost.alias("lost_chars"),
    )


def clean(docs: DataFrame, most_lost: float = MOST_LOST, least_words: int = LEAST_WORDS) -> DataFrame:
    """Documents that pass, all columns as they are but `text`, which loses the lines that fail."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # the measures are taken of the text as it came, so they stand below the change of it
    name = free_name("_measures", docs.columns)
    measured = docs.withColumn(name, measures(F.col("text")))
    m = F.col(name)
    lost = m["word_chars"] - m["left"]["chars"]
    passed = (
        (m["words"]["n"] >= least_words) & (m["words"]["repeated"] <= MOST_REPEATED * m["words"]["n"])
        & (m["left"]["words"] >= least_words) & (lost <= most_lost * m["word_chars"])
    )
    return measured.where(passed).drop(name).withColumn("text", F.array_join(kept_lines(text), "\n"))
