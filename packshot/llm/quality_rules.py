"""Quality rules on the divergence of a document from its language, in DataFrame functions alone.

Each document becomes two histograms: its characters by class, and its words by the common words of its
language with one bin for all others. The references are the sums of the histograms of all long enough
documents of a language that pass the base rules; they are summed anew without the documents that are far
from the first sums, so that junk does not shape what is normal. A document is dropped when the
Jensen-Shannon distance (root of the base-2 divergence) of either histogram exceeds its limit. A limit is
``share + noise / sqrt(n_words)``, as the distance of a sample from its own source falls with that root.
Two guards lie above the least length of the base rules: documents with fewer words, or fewer characters in words, than
these have histograms that are mostly noise. They are judged by the base rules alone and do not shape the references.

Null texts have no words. A null language is a language of its own. Languages without a word list use the
words of all lists. Repeated rows are judged one by one; extra columns are ignored. Empty tables give no row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packshot.runtime import broadcast_if_small, materialise

MIN_WORDS, REPEAT_PERCENT = 50, 50
# the least words and characters in words of a histogram that says something
GUARD_WORDS, GUARD_CHARS = 60, 300
# share and noise of the limits
CHAR_LIMIT, WORD_LIMIT = (0.1, 1.5), (0.06, 2.35)

# frequent function words of the languages, for the word histograms
COMMON = {
    "en": "the of and to in a is that it on for was with as be this by are at an from or not which",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an bei",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se avec",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o",
}
ALL_WORDS = sorted({w for words in COMMON.values() for w in words.split()})
# class name -> what is taken away to count it
CLASSES = {"lower": "[a-z]+", "upper": "[A-Z]+", "digit": "[0-9]+", "stop": "[.,;:]+", "mark": "[!?]+"}
_SPACES = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def word_array(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPACES), lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more."""

    def covered(at: Column) -> Column:  # sorted first words of repeated windows
        return F.aggregate(
            at,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
            lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")),
            lambda s: s["n"],
        )

    def found(hashes: Column) -> Column:
        return let(
            let(F.sort_array(hashes), lambda s: F.array_distinct(F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1))))),
            lambda twice: F.when(F.size(twice) == 0, F.lit(0).cast("long"))
            .when(F.size(twice) <= 32, covered(_few(hashes, twice)))
            .otherwise(covered(_many(hashes))),
        )

    def _few(hashes: Column, twice: Column) -> Column:
        marked = F.transform(hashes, lambda h, i: F.when(F.array_contains(twice, h), i))
        return F.filter(marked, lambda i: i.isNotNull())

    def _many(hashes: Column) -> Column:  # sorted with their places, each beside its equals
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            pairs,
            lambda p: F.sort_array(
                F.transform(
                    F.filter(p, lambda x, i: (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"])), lambda x: x["i"]
                )
            ),
        )

    n = F.size(words)
    windows = lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(windows(words), found))


def _bin_counts(terms: Column, words: list[str]) -> Column:
    bins = F.array(*[F.lit(w) for w in words])
    return let(
        F.transform(terms, F.lower),
        lambda found: F.transform(bins, lambda w: F.size(F.filter(found, lambda x: x == w)).cast("long")),
    )


def document_counts(docs: DataFrame) -> DataFrame:
    """Base counts and both histograms of every document; one pass, no shuffle."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    length = F.length("_text")
    plain = lambda pattern: F.length(F.regexp_replace("_text", pattern, ""))
    counted = (
        docs.select("doc_id", F.col("lang").cast("string").alias("lang"), text.alias("_text"))
        .withColumn("_words", word_array(F.col("_text")))
        .withColumn("n_words", F.size("_words").cast("long"))
    )
    # a space belongs to every text: as one character per word, so that runs of blanks don't count
    classes = [(length - plain(p)).cast("long") for p in CLASSES.values()]
    word_chars = plain(_SPACES).cast("long")
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.regexp_replace(x, _SPACES, "")) > 0)
    common = F.filter("_words", lambda w: F.lower(w).isin(ALL_WORDS))
    per_language = F.lit(None).cast("array<long>")
    for lang, words in [*COMMON.items(), (None, " ".join(ALL_WORDS))]:
        counts = _bin_counts(common, words.split())
        known = F.col("lang") == lang if lang else ~F.coalesce(F.col("lang").isin(list(COMMON)), F.lit(False))
        per_language = F.when(known, counts).otherwise(per_language)
    return counted.select(
        "doc_id",
        "lang",
        "n_words",
        word_chars.alias("word_chars"),
        (length - plain("[#*$%&|<>]+")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_words")).alias("n_repeat_words"),
        F.array(*classes).alias("_classes"),
        per_language.alias("_common"),
    ).select(
        "*",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def _histograms(counts: DataFrame) -> DataFrame:
    """The last bin of each histogram holds the rest."""
    rest = lambda whole, part: F.concat(part, F.array(F.greatest(whole - _sum(part), F.lit(0).cast("long"))))
    symbols = F.concat(F.col("_classes"), F.array("n_symbols"))
    return counts.withColumn("_chars", rest(F.col("word_chars"), symbols)).withColumn("_terms", rest(F.col("n_words"), F.col("_common")))


def long_enough(guard_words: int, guard_chars: int) -> Column:
    return (F.col("n_words") >= guard_words) & (F.col("word_chars") >= guard_chars)


def language_references(counts: DataFrame, guard_words: int = GUARD_WORDS, guard_chars: int = GUARD_CHARS) -> DataFrame:
    """Summed histograms per language: ``lang, _ref_chars, _ref_terms``."""
    fit = _histograms(counts).where(~F.col("base_failed") & long_enough(guard_words, guard_chars))
    n_chars = len(CLASSES) + 2
    n_terms = max(len(ALL_WORDS), *(len(w.split()) for w in COMMON.values())) + 1
    sums = [F.sum(F.get(F.col("_chars"), F.lit(i))).alias(f"c{i}") for i in range(n_chars)]
    sums += [F.sum(F.get(F.col("_terms"), F.lit(i))).alias(f"t{i}") for i in range(n_terms)]
    gathered = lambda p, n: F.filter(F.array(*[f"{p}{i}" for i in range(n)]), lambda x: x.isNotNull())
    return fit.groupBy(F.col("lang").alias("_lang")).agg(*sums).select(
        "_lang", gathered("c", n_chars).alias("_ref_chars"), gathered("t", n_terms).alias("_ref_terms")
    )


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts; 0 where one is empty."""

    def divergence(p: Column, q: Column) -> Column:
        half = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
        term = lambda x, y: (half(x, (x + y) / 2) + half(y, (x + y) / 2)) / 2
        return F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda a, b: a + b)

    share = lambda x, total: F.transform(x, lambda v: v / total)
    return let(
        F.struct(_sum(counts).alias("n"), _sum(reference).alias("m")),
        lambda t: F.when((t["n"] > 0) & (t["m"] > 0), F.sqrt(F.greatest(F.lit(0.0), divergence(share(counts, t["n"]), share(reference, t["m"]))))).otherwise(0.0),
    )


def _distances(counts: DataFrame, references: DataFrame) -> DataFrame:
    """``counts`` with both distances; a language without a reference is at distance 0."""
    both = _histograms(counts).join(broadcast_if_small(references), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    return both.select(
        *counts.columns,
        F.coalesce(js_distance(F.col("_chars"), F.col("_ref_chars")), F.lit(0.0)).alias("char_distance"),
        F.coalesce(js_distance(F.col("_terms"), F.col("_ref_terms")), F.lit(0.0)).alias("word_distance"),
    )


def _far(guard_words: int, guard_chars: int, char_limit: tuple[float, float], word_limit: tuple[float, float]) -> Column:
    over = lambda name, limit: F.col(name) > limit[0] + limit[1] / F.sqrt("n_words")
    return long_enough(guard_words, guard_chars) & (over("char_distance", char_limit) | over("word_distance", word_limit))


def judged(
    docs: DataFrame,
    guard_words: int = GUARD_WORDS,
    char_limit: tuple[float, float] = CHAR_LIMIT,
    word_limit: tuple[float, float] = WORD_LIMIT,
    guard_chars: int = GUARD_CHARS,
) -> DataFrame:
    """Every document with its base counts, both distances, ``base_failed`` and ``kept``."""
    far = _far(guard_words, guard_chars, char_limit, word_limit)
    counts = materialise(document_counts(docs))
    all_sums = materialise(language_references(counts, guard_words, guard_chars))
    near = _distances(counts, all_sums).where(~far).select(*counts.columns)
    near_sums = language_references(near, guard_words, guard_chars)
    # a language without any document near its own sums keeps these
    alone = all_sums.join(near_sums.select(F.col("_lang").alias("_near")), F.col("_lang").eqNullSafe(F.col("_near")), "left_anti")
    distances = _distances(counts, materialise(near_sums.unionByName(alone)))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return distances.select(*names, (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance")
