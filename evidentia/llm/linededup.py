"""Removal of passages that repeat across documents, by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import discard, let, materialise, number_of, numbered_columns, own_columns

#: Consecutive lines in one window.
WINDOW = 3
#: Texts are cut after line ends and after sentence ends, as passages also repeat inside longer lines.
CUT = r"(?<=\n)|(?<=[.!?] )"
BLANK = " \t\n\r\x0b\f"


def _units(text: Column) -> Column:
    """The lines of a text with their ends: together they are the text."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), CUT, -1)


def _worded(units: Column) -> Column:
    """``(at, h, g)`` for each line with a word: its place in ``units`` and two hashes of the line less the white space around it."""
    bare = F.transform(units, lambda u: F.btrim(u, F.lit(BLANK)))
    hashed = F.transform(bare, lambda u, i: F.when(u != "", F.struct(i.alias("at"), F.xxhash64(u).alias("h"), F.hash(u).alias("g"))))
    return F.filter(hashed, lambda x: x.isNotNull())


def windows_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(id, mark, k, h, g)``: the windows of each row (mark: hash of its text), k the number, from 0, of its first line with a word.

    A window is ``window`` consecutive lines that have a word; those without are passed over. A text with fewer
    has one window of all it has. ``h`` and ``g`` are 96 bits of hashes over the lines' hashes: each line is hashed once.
    """
    text = F.col(text_col).cast("string")
    lines = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), _worded(_units(text)).alias("lines")).filter("size(lines) > 0")
    starts = F.greatest(F.size("lines") - (window - 1), F.lit(1))
    shifted = F.arrays_zip(*(F.slice("lines", d + 1, starts).alias(f"w{d}") for d in range(window)))
    rows = lines.select("id", "mark", F.posexplode(shifted).alias("k", "w"))
    parts = [F.col(f"w.w{d}") for d in range(window)]
    return rows.select("id", "mark", "k", F.xxhash64(*(x["h"] for x in parts)).alias("h"), F.hash(*(x["g"] for x in parts)).alias("g"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(id, mark, ks)``: per row the numbers, among its lines with a word, of lines in windows that an earlier place has too.

    The first place of a window is that with the least id (null last), then mark, then line. Counts and least ids
    are combined before the shuffle and joined back; the plan is the same at every size, and AQE may
    split the rows of a window that a third of all documents have.
    """
    found = materialise(windows_of(docs, id_col, text_col, window), "line-windows")
    firsts = found.groupBy("h", "g").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = materialise(firsts.select("h", "g", "first"), "line-firsts")
    met = materialise(found.join(firsts.hint("merge"), ["h", "g"]).select("h", "g", "id", "mark", "k", F.col("id").eqNullSafe(F.col("first")).alias("least")), "line-met")
    discard(found, firsts)
    # Of several places under the least id the first in order stays.
    ties = met.filter("least").groupBy("h", "g").agg(F.min(F.struct("mark", "k")).alias("stays"), F.count("*").alias("n")).filter("n > 1").select("h", "g", "stays")
    tied = met.filter("least").join(ties.hint("merge"), ["h", "g"]).filter(F.struct("mark", "k") != F.col("stays"))
    later = met.filter("not least").select("id", "mark", "k").union(tied.select("id", "mark", "k"))
    lines = later.select("id", "mark", F.explode(F.sequence(F.col("k"), F.col("k") + (window - 1))).alias("k"))
    out = materialise(lines.groupBy("id", "mark").agg(F.array_sort(F.collect_set("k")).alias("ks")), "line-removals")
    discard(met)
    return out


def _without(units: Column, ks: Column) -> Column:
    """``(text, n)``: the lines left and the number of those gone, where ``ks`` number lines with a word.

    Runs of consecutive numbers go from their first line to their last, lines without a word between included.
    """

    def cut(at: Column, there: Column) -> Column:
        starts = F.filter(there, lambda p, i: (i == 0) | (F.get(there, i - 1) != p - 1))
        ends = F.filter(there, lambda p, i: (i == F.size(there) - 1) | (F.get(there, i + 1) != p + 1))
        gone = F.flatten(F.zip_with(starts, ends, lambda a, z: F.sequence(F.get(at, a), F.get(at, z))))

        def rest(out: Column) -> Column:
            left = F.array_except(F.sequence(F.lit(0), F.size(units) - 1), out)
            return F.struct(F.array_join(F.transform(left, lambda i: units[i]), "").alias("text"), F.size(out).cast("long").alias("n"))

        return let(gone, rest)

    numbers = F.transform(_worded(units), lambda x: x["at"])
    return let(numbers, lambda at: let(F.filter(ks, lambda k: k < F.size(at)), lambda there: cut(at, there)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with its texts less the lines that later occurrences of repeated windows cover, and ``n_removed`` (long).

    Lines end at line ends and sentence ends. Covered places of overlapping windows are merged and go whole; the
    first occurrence of each window stays. Texts without a removal, null and empty ones
    included, are returned as they were. Equal texts under other ids are later occurrences and lose all their
    lines; rows that repeat both id and text are one row here, so neither makes the other lose lines.
    Texts are joined once, by row. A column ``n_removed`` of ``docs`` is replaced; other names can't clash.
    """
    bare = numbered_columns(docs)
    own_id, own_text = number_of(docs, id_col), number_of(docs, text_col)
    side = repeated_lines(bare, own_id, own_text, window)
    named = bare.withColumn("own", F.xxhash64(F.col(own_text).cast("string")))
    joined = named.join(side.hint("merge"), F.col(own_id).eqNullSafe(F.col("id")) & (F.col("own") == F.col("mark")), "left")
    cut = let(_units(F.col(own_text)), lambda u: _without(u, F.col("ks")))
    joined = joined.withColumn("cut", F.when(F.col("ks").isNotNull(), cut))
    out = joined.withColumn(own_text, F.when(F.col("cut.n") > 0, F.col("cut.text")).otherwise(F.col(own_text)))
    return out.select(*own_columns(docs, ("n_removed",)), F.coalesce("cut.n", F.lit(0).cast("long")).alias("n_removed"))
