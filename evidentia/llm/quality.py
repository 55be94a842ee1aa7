"""Quality rules with thresholds that adapt to each language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import SMALL_ROWS, WORD, let, materialise, number_of, numbered_columns, own_columns

#: Fixed rule of the base: fewer words, or a larger share of repeated words, fails.
LEAST_WORDS, REPEAT_PERCENT = 50, 50
#: KLL sketch size: rank error about 1 %.
SKETCH_K = 400
#: Documents that a group needs for thresholds of its own; smaller ones take their language's, then all.
LEAST_GROUP = 100
#: Fences: median plus or minus REACH times the distance of median and lower decile, or times the counting error if that is larger.
REACH = 10.0
#: Ranks of a sketch between which a step is looked for, where most documents have the same value.
RANKS = (0.85, 0.9, 0.92, 0.94, 0.96, 0.98, 0.99, 1.0)
#: Measures by name: the side that fails ("high" or "both").
RULES = {"symbol_ratio": "high", "upper_ratio": "high", "word_length": "both"}
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: Column) -> Column:
    """Words in three-word windows found twice or more in the array, first included.

    Windows are compared by 64-bit hashes. Without a repeat, which a hash set tells, that is all. Else
    hashes are sorted with their places, those with an equal neighbour repeat, and covered words are summed over
    the sorted places: no step is worse than n log n.
    """
    n = F.size(words)

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        step = lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["p"])).alias("n"), p.alias("p"))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("p"))
        return let(pairs, lambda s: F.aggregate(places(s), start, step, lambda acc: acc["n"]))

    def count(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))

    return F.when(n < 3, F.lit(0)).otherwise(let(words, count)).cast("long")


def base_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (longs) of the whole text (null: zeros)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    both = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("r")))
    out = docs.withColumn("_w", both)
    return out.withColumns(
        {
            "n_words": F.col("_w.n"),
            "word_chars": _word_chars(text),
            "n_symbols": _symbols(text),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": F.col("_w.r"),
        }
    ).drop("_w")


def _word_chars(text: Column) -> Column:
    for space in " \n\t\x0b\f\r":
        text = F.replace(text, F.lit(space), F.lit(""))
    return F.length(text).cast("long")


def _symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long")


def measures(known: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``base_statistics`` with the measure of each of RULES; null where the text has fewer than LEAST_WORDS words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    upper = F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", ""))
    found = {"symbol_ratio": F.col("n_symbols") / F.col("word_chars"), "upper_ratio": upper / F.col("word_chars"), "word_length": F.col("word_chars") / F.col("n_words")}
    return known.withColumns({k: F.when(F.col("n_words") >= LEAST_WORDS, v.cast("double")) for k, v in found.items()})


def thresholds(measured: DataFrame, lang_col: str = "lang", source_col: str = "source", least: int = LEAST_GROUP) -> DataFrame:
    """``(lang, source, n, <rule>_low, <rule>_high)`` for each group, from quantile sketches.

    One KLL sketch for each rule, language and source, combined before the shuffle; the sketches merge to
    those of each language and of all documents, which groups with fewer than ``least`` measured documents
    use. Null languages and sources are groups like any other. No fence is fixed.

    Capitals and word lengths vary in all documents: their fence is the median and REACH times its distance to the lower
    decile, or times the counting error at the group's own median if that is larger. Symbols most documents have none of, so there the
    fence is the middle of the first step between neighbouring quantiles of RANKS, the greatest value included. A step counts if it is
    wider than the distance of its foot to the median and than REACH symbols in a text of median length;
    without one no document stands apart, and the rule fails none.
    """
    sizes = {"chars": F.when(F.col("n_words") >= LEAST_WORDS, F.col("word_chars").cast("double")), "words": F.when(F.col("n_words") >= LEAST_WORDS, F.col("n_words").cast("double"))}
    sketched = measured.withColumns(sizes)
    names = [*RULES, *sizes]
    groups = sketched.groupBy(F.col(lang_col).alias("lang"), F.col(source_col).alias("source")).agg(F.count(names[0]).alias("n"), *(F.kll_sketch_agg_double(r, SKETCH_K).alias(r) for r in names))
    groups = materialise(groups, "quality-sketches")
    merged = [F.sum("n").alias("n"), *(F.kll_merge_agg_double(r, SKETCH_K).alias(r) for r in names)]
    by_lang = groups.groupBy("lang").agg(*merged)
    overall = groups.agg(*merged)
    wide = (
        groups.select("lang", "source", "n", F.struct("n", *names).alias("g"))
        .join(by_lang.select(F.col("lang").alias("lang_"), F.struct("n", *names).alias("l")), F.col("lang").eqNullSafe(F.col("lang_")), "left")
        .join(F.broadcast(overall.select(F.struct("n", *names).alias("a"))))
    )
    used = F.when(F.col("g.n") >= least, F.col("g")).when(F.col("l.n") >= least, F.col("l")).otherwise(F.col("a"))
    out = wide.select("lang", "source", "n", used.alias("s"))
    quantile = lambda name, q: F.when(F.col("s.n") > 0, F.kll_sketch_get_quantile_double(F.col(f"s.{name}"), F.lit(q)))
    cols = ["lang", "source", "n"]
    for rule, side in RULES.items():
        middle = quantile(rule, 0.5)
        if rule == "symbol_ratio":
            at = [quantile(rule, q) for q in RANKS]
            steps = [F.when(b - a > F.greatest(a - middle, REACH / quantile("chars", 0.5)), (a + b) / 2) for a, b in zip(at, at[1:], strict=False)]
            cols += [F.coalesce(*steps).alias(f"{rule}_high"), F.lit(None).cast("double").alias(f"{rule}_low")]
            continue
        if rule == "word_length":
            error = middle / 2 / F.sqrt(quantile("words", 0.5))
        else:
            error = F.sqrt(F.greatest(F.lit(1.0), middle * quantile("chars", 0.5))) / quantile("chars", 0.5)
        reach = REACH * F.greatest(middle - quantile(rule, 0.1), error)
        cols += [(middle + reach).alias(f"{rule}_high"), (middle - reach if side == "both" else F.lit(None).cast("double")).alias(f"{rule}_low")]
    return out.select(*cols)


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", with_text: bool = True) -> DataFrame:
    """``docs`` with the base statistics, the measures, ``base_failed`` and ``kept``.

    A document is kept if the base rule doesn't fail it and each measure lies within the fences of its
    language and source. Texts are scanned once: the statistics are written with the rows (without the text if not
    ``with_text``, which also leaves it out of the result), and thresholds come from the numbers. Columns of ``docs`` are kept; those with
    the names of added ones are replaced; other names can't clash. Null and
    empty texts have no words and fail the base rule. Thresholds are joined as a small table: up to
    SMALL_ROWS groups are broadcast, more are joined by shuffle, which AQE splits where a source is hot.
    """
    bare = numbered_columns(docs)
    text, lang, source = (number_of(docs, c) for c in (text_col, lang_col, source_col))
    known = measures(base_statistics(bare, text), text)
    known = materialise(known if with_text else known.drop(text), "quality-statistics")
    limits = materialise(thresholds(known, lang, source), "quality-limits").drop("n")
    if limits.count() <= SMALL_ROWS:
        limits = F.broadcast(limits)
    met = known.join(limits, F.col(lang).eqNullSafe(F.col("lang")) & F.col(source).eqNullSafe(F.col("source")), "left")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    inside = F.lit(True)
    for rule in RULES:
        inside = inside & F.coalesce(F.col(rule) <= F.col(f"{rule}_high"), F.lit(True)) & F.coalesce(F.col(rule) >= F.col(f"{rule}_low"), F.lit(True))
    added = (*STATISTICS, *RULES, "base_failed", "kept")
    out = met.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & inside)
    return out.select(*own_columns(docs, added if with_text else (*added, text_col)), *added)


def keep_good(docs: DataFrame, **columns) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    bare = numbered_columns(docs)
    at = {k: number_of(docs, columns.get(k, d)) for k, d in (("text_col", "text"), ("lang_col", "lang"), ("source_col", "source"))}
    return judge(bare, **at).filter("kept").select(*own_columns(docs))
