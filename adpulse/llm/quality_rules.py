"""Quality rules whose thresholds adapt to language and source.

Each text has a few counts. Their rates feed a mergeable quantile sketch per
(language, source). The quartiles of a group of n rows are weighed n to
PRIOR_ROWS against those of its language, and these in the same way against
those of all rows: a small group leans on the larger ones, and nothing jumps
as it grows. A rate is out of line if it lies beyond
the quartiles of its group by three times their distance, or by three times a
least distance where a group hardly varies. The thresholds, one row per group,
are joined to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import WORD, let, packed, quoted, small, stored, unpacked

SYMBOL = r"[#*$%&|<>]"
MIN_WORDS = 50
MOST_REPEATED = 50      # percent of the words
PRIOR_ROWS = 100        # weight, in rows, of the quartiles one level up
SKETCH_SIZE = 2000      # KLL parameter k: rank error about 0.1 %
FENCE = 3.0
# Rates of a text (numerator, denominator) and the least distance of their quartiles.
RATES = {
    "symbol_rate": ("n_symbols", "word_chars", 0.01),
    "line_rate": ("n_dup_lines", "n_words", 0.005),
    "repeat_rate": ("n_repeat_words", "n_words", 0.05),
    "word_length": ("word_chars", "n_words", 0.5),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _key(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(name)), F.lit("-"))


def _rate(name: str) -> Column:
    part, whole, _ = RATES[name]
    return F.col(part) / F.greatest(whole, F.lit(1))


def repeated_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more in the text. Windows
    are sorted by hash with their places, so long texts take n log n."""
    def windows(w):
        return F.when(F.size(w) >= 3, F.transform(
            F.sequence(F.lit(1), F.size(w) - 2),
            lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)))).otherwise(F.array().cast("array<bigint>"))

    def repeated(s):
        def again(j):
            own = F.element_at(s, j)["h"]
            return (((j > 1) & (F.element_at(s, F.greatest(j - 1, F.lit(1)))["h"] == own))
                    | ((j < F.size(s)) & (F.element_at(s, F.least(j + 1, F.size(s)))["h"] == own)))
        return F.transform(F.filter(F.sequence(F.lit(1), F.size(s)), again), lambda j: F.element_at(s, j)["i"])

    def covered(places):
        none = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
        return F.aggregate(F.sort_array(places), none, lambda a, p: F.struct(
            (a["words"] + p + 3 - F.greatest(p, a["end"])).alias("words"), (p + 3).alias("end")))["words"]

    def count(g):
        places = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(let(places, repeated)))

    return let(let(words, windows), count)


def base_counts(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the five counts, long, and ``base_failed``."""
    lines = F.filter(F.split("text_", "\n", -1), lambda line: line.rlike(WORD))
    return (df.withColumn("text_", F.coalesce(text, F.lit("")))
            .withColumn("words_", F.regexp_extract_all("text_", F.lit(WORD), F.lit(0))).withColumn("lines_", lines)
            .withColumns({
                "n_words": F.size("words_").cast("long"),
                "word_chars": F.char_length(F.array_join("words_", "")).cast("long"),
                "n_symbols": F.char_length(F.regexp_replace("text_", SYMBOL.replace("[", "[^", 1), "")).cast("long"),
                "n_dup_lines": (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long"),
                "n_repeat_words": repeated_words(F.col("words_")).cast("long")})
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
            .drop("text_", "words_", "lines_"))


def thresholds(rows: DataFrame) -> DataFrame:
    """(lang, source, <rate>_low, <rate>_high): one row per language and source
    of ``rows``, from the rows that the base rules pass."""
    passed = rows.where("not base_failed")
    groups = stored(passed.groupBy("lang", "source").agg(F.count("*").alias("n"), *[
        F.kll_sketch_agg_double(_rate(name), F.lit(SKETCH_SIZE)).alias(name) for name in RATES]), "rules-sketches")

    def merged(suffix: str) -> list[Column]:
        return [F.sum("n").alias("n" + suffix), *[F.kll_merge_agg_double(name).alias(name + suffix) for name in RATES]]

    # joined on keys that are never null; "any" is true for every group
    keyed = groups.withColumns({"lang_key": _key("lang"), "any": F.col("n") > 0})
    by_lang = keyed.groupBy("lang_key").agg(*merged("_lang"))
    overall = keyed.groupBy("any").agg(*merged("_all"))
    levels = keyed.join(by_lang, "lang_key").join(overall, "any")
    out = []
    for name, (_, _, least) in RATES.items():
        def quartile(q):
            own, lang, every = (F.kll_sketch_get_quantile_double(F.col(name + level), F.lit(q)) for level in ("", "_lang", "_all"))
            above = (F.col("n_lang") * lang + PRIOR_ROWS * every) / (F.col("n_lang") + PRIOR_ROWS)
            return (F.col("n") * own + PRIOR_ROWS * above) / (F.col("n") + PRIOR_ROWS)

        q1, q3 = quartile(0.25), quartile(0.75)
        spread = F.greatest(q3 - q1, F.lit(least))
        out += [(q1 - FENCE * spread).alias(name + "_low"), (q3 + FENCE * spread).alias(name + "_high")]
    return levels.select("lang", "source", *out)


def _judged(df: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(row, counts, base_failed, kept)."""
    rows = packed(df, quoted(text_col).alias("given"), quoted(lang_col).alias("lang"), quoted(source_col).alias("source"))
    rows = stored(base_counts(rows, F.col("given")).drop("given"), "rules-counts")
    limits = stored(thresholds(rows), "rules-thresholds")
    keys = {"lang_key": _key("lang"), "source_key": _key("source")}
    limits = small(limits.withColumns(keys).drop("lang", "source"), limits.count() * 256)
    joined = rows.withColumns(keys).join(limits, list(keys), "left")
    usual = F.lit(True)
    for name in RATES:
        usual = usual & F.coalesce(_rate(name).between(F.col(name + "_low"), F.col(name + "_high")), F.lit(True))
    return joined.select("row", *COUNTS, "base_failed", (~F.col("base_failed") & usual).alias("kept"))


def quality_rules(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """All rows and columns of ``df`` with n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails the base rules. Null languages
    and sources are groups of their own. Repeated rows count as often as they
    occur and get the same verdict. An empty table gives an empty result.
    Input columns that have an output's name give way to it.
    """
    names = [*COUNTS, "base_failed", "kept"]
    return unpacked(_judged(df, text_col, lang_col, source_col), df.columns, {c: F.col(c) for c in names})
