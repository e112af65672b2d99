"""Quality rules: basic counts, and how far a text's histograms are from its language's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from changeflow.llm.common import WORD_GAP, whole_text
from changeflow.session import written

# White space between words, symbols, classes of characters, and
# common words of English, German, French and Spanish.
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]+"
CLASSES = (  # what else there is, is a class too
    "[a-z]+", "[A-Z]+", "[0-9]+", WORD_GAP, r"""[.,;:'"?!()-]+""", "[#*$%&]+",
    r"[|<>{}\[\]\\/=+_~^@`]+",
)
COMMON = (
    "the of and to a in is that it for was on with as be by this are at from "
    "der die und den von zu das mit sich für auf des ist im nicht dem ein eine als "
    "de la le et les en un du une que est pour qui dans au par sur pas avec "
    "el y los se del las por con no su para al lo como más"
).split()

MIN_WORDS = 50
REPEATED = 50  # percent of the words at most that may lie in repeated windows
WINDOW = 3
LOOKED_UP = 24  # repeated windows that are looked up one by one
STEPS = 1000  # steps in which shares of characters are ranked
CHARS_FAR, CHARS_NOISE = 0.18, 0.4  # distance allowed, and what is added for short texts
WORDS_FAR, WORDS_FROM = 0.42, 100  # distance allowed, from this many words on


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """What white space parts."""
    inner = F.btrim(text, F.lit(WHITE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WORD_GAP))


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three that the text has twice or more.

    Windows are compared by 64-bit hashes. Most texts repeat few: if their hashes
    are few, each window is looked up among them; otherwise windows are ranked, so
    that the work stays near the number of words.
    """
    def hashed(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])

    def covered(places: Column) -> Column:
        reach = F.transform(places, lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

    def ranked(rank: Column) -> Column:
        def twice(k: Column) -> Column:
            own = F.get(rank, k)["h"]
            return F.coalesce(F.get(rank, k - 1)["h"] == own, F.lit(False)) \
                | F.coalesce(F.get(rank, k + 1)["h"] == own, F.lit(False))
        places = F.filter(F.transform(rank, lambda x, k: F.when(twice(k), x["i"])),
                          lambda i: i.isNotNull())
        return let(F.sort_array(places), covered)

    def counted(hashes: Column) -> Column:
        def again(ordered: Column) -> Column:
            return F.array_distinct(F.filter(ordered, lambda h, k: h == F.get(ordered, k + 1)))

        def placed(known: Column) -> Column:
            places = F.filter(F.sequence(F.lit(0), F.size(hashes) - 1),
                              lambda i: F.array_contains(known, F.get(hashes, i)))
            rank = F.sort_array(F.transform(
                hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
            return F.when(F.size(known) == 0, F.lit(0)) \
                .when(F.size(known) <= LOOKED_UP, let(places, covered)) \
                .otherwise(let(rank, ranked))
        return let(let(F.sort_array(hashes), again), placed)

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), hashed)
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(let(windows, counted))


def common_counts(words: Column) -> Column:
    """How often each of the common words stands in the text, small or capitalised."""
    forms = [*COMMON, *(w.capitalize() for w in COMMON)]
    found = F.filter(words, lambda w: w.isin(forms))
    joined = F.lower(F.concat(F.lit(" "), F.array_join(found, "  "), F.lit(" ")))

    def counts(text: Column) -> Column:
        return F.transform(F.array(*map(F.lit, COMMON)), lambda w: (
            (F.octet_length(text) - F.octet_length(
                F.replace(text, F.concat(F.lit(" "), w, F.lit(" ")), F.lit(""))))
            / (F.octet_length(w) + 2)).cast("bigint"))
    return let(joined, counts)


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def class_counts(text: Column) -> Column:
    """How many characters of each class the text has, and of all others."""
    first, *others = CLASSES

    def of_rest(rest: Column) -> Column:
        return F.array(F.length(text) - F.length(rest), *[_count(rest, c) for c in others])

    def closed(counts: Column) -> Column:
        known = F.aggregate(counts, F.lit(0), lambda total, n: total + n)
        return F.concat(counts, F.array(F.length(text) - known))
    return let(let(F.regexp_replace(text, first, ""), of_rest), closed)


def divergence(counts: Column, reference: Column) -> Column:
    """The Jensen-Shannon distance (base 2, 0 to 1) between counts and weights."""
    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    def distance(p: Column, q: Column) -> Column:
        parts = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
        return F.sqrt(F.greatest(total(parts) / 2, F.lit(0.0)))

    def shares(values: Column) -> Column:
        return let(total(values), lambda s: F.transform(values, lambda v: v / s))

    return let(shares(counts), lambda p: let(shares(reference), lambda q: distance(p, q)))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as (row, base, classes, common): counts of each whole text.

    ``row`` holds the columns but the text. ``base`` has n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words and base_failed.
    """
    rest = [c for c in docs.columns if c != text]
    whole = docs.select(F.struct(*rest).alias("row"), whole_text(text).alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    counted = whole.select(
        "row", "text",
        let(words_of(F.col("text")), lambda w: F.struct(
            F.size(w).alias("n_words"), repeated_words(w).alias("n_repeat_words"),
            common_counts(w).alias("common"))).alias("words"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        class_counts(F.col("text")).alias("classes"),
        _count(F.col("text"), SYMBOLS).alias("n_symbols"))
    n, again = F.col("words.n_words"), F.col("words.n_repeat_words")
    white = F.get("classes", F.lit(CLASSES.index(WORD_GAP)))
    base = {"n_words": n, "word_chars": F.length("text") - white, "n_symbols": F.col("n_symbols"),
            "n_dup_lines": F.col("n_dup_lines"), "n_repeat_words": again}
    failed = (n < MIN_WORDS) | (F.lit(100).cast("bigint") * again > F.lit(REPEATED) * n)
    return counted.select(
        "row", F.struct(*[c.cast("bigint").alias(k) for k, c in base.items()],
                        failed.alias("base_failed")).alias("base"),
        F.col("classes").cast("array<bigint>").alias("classes"), F.col("words.common").alias("common"))


def references(measured: DataFrame, language: Column) -> DataFrame:
    """For each language of rows that pass the base rules its histograms.

    The share of a class of characters is the median over the language's texts,
    in steps of a thousandth; the weights of common words, and of all others, are
    sums over its texts.
    """
    passed = measured.where(~F.col("base.base_failed")).select(
        language.alias("language"), "base", "classes", "common")
    chars = F.aggregate("classes", F.lit(0).cast("bigint"), lambda s, n: s + n)
    steps = passed.select("language", chars.alias("chars"),
                          F.posexplode("classes").alias("at", "n")) \
        .groupBy("language", "at", F.expr(f"n * {STEPS} DIV chars").alias("step")) \
        .agg(F.count(F.lit(1)).alias("texts"))
    # At most STEPS + 1 rows for each language and class.
    whole = Window.partitionBy("language", "at")
    upto = whole.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    medians = steps.select("language", "at", "step", F.sum("texts").over(upto).alias("below"),
                           F.sum("texts").over(whole).alias("all")) \
        .where("2 * below >= all").groupBy("language", "at").agg(F.min("step").alias("n"))
    others = F.col("base.n_words") - F.aggregate("common", F.lit(0).cast("bigint"),
                                                 lambda s, n: s + n)
    words = passed.select("language", F.posexplode(F.concat("common", F.array(others)))
                          .alias("at", "n")).groupBy("language", "at").agg(F.sum("n").alias("n"))

    def listed(table: DataFrame, name: str) -> DataFrame:
        order = F.sort_array(F.collect_list(F.struct("at", F.col("n").cast("double").alias("n"))))
        return table.groupBy("language").agg(order["n"].alias(name))
    return listed(medians, "class_reference").join(
        listed(words, "word_reference").withColumnRenamed("language", "other"),
        F.col("language").eqNullSafe(F.col("other"))).drop("other")


def judge_quality(spark: SparkSession, docs: DataFrame, text: str = "text",
                  language: str = "lang") -> DataFrame:
    """Each row of ``docs``, without the text, with its counts and verdict.

    New columns are n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, class_distance, word_distance and kept; columns of the same
    names are replaced. A text fails the base rules with fewer than ``MIN_WORDS``
    words or with more than ``REPEATED`` percent of them in repeated windows of
    three. One that passes is dropped if the Jensen-Shannon distance of its
    character classes from its language's is above ``CHARS_FAR`` and a part that
    shrinks with the root of its words, or, with ``WORDS_FROM`` words or more, that
    of its common words is above ``WORDS_FAR``.

    A null text has no words; a text of any length is judged whole. Null is a language of its own. In a language none of
    whose texts pass the base rules nothing is compared. Repeated rows count again
    in the references and are judged alike; an empty table gives no rows.
    """
    measured = written(measure(docs, text), "measured")
    own = F.col("row")[language]
    known = references(measured, own)
    judged = measured.join(known, own.eqNullSafe(F.col("language")), "left")
    n = F.col("base.n_words")
    others = n - F.aggregate("common", F.lit(0).cast("bigint"), lambda s, c: s + c)
    passed = ~F.col("base.base_failed")
    judged = judged.withColumns({
        "class_distance": F.when(passed, divergence(F.col("classes").cast("array<double>"),
                                                    F.col("class_reference"))),
        "word_distance": F.when(passed & (n >= WORDS_FROM), divergence(
            F.concat("common", F.array(others)).cast("array<double>"), F.col("word_reference"))),
    })
    far = (F.col("class_distance") > CHARS_FAR + CHARS_NOISE / F.sqrt(n)) \
        | F.coalesce(F.col("word_distance") > WORDS_FAR, F.lit(False))
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    names = {*new, "class_distance", "word_distance", "kept"}
    return judged.select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c != text and c.lower() not in names],
        *[F.col(f"base.{c}") for c in new], "class_distance", "word_distance",
        (passed & ~F.coalesce(far, F.lit(False))).alias("kept"))
