"""Repeated passages of 50 words and more, found by winnowing (operator 7).

DataFrame operations only.  Words are what white space parts; passages are equal
if their words are, so they may start and end in the middle of a line, and lines
may be broken elsewhere: what is hashed are runs of words, whatever lines they stand in.

1. Words are hashed, and each has a rank by its hash and the next word's, which is another word:
   one in 24 has the first rank, one in 8 of all at least the second, and all others the third.
   The point of a window of ``MIN_WORDS`` words is the first word of the best rank in it.  Windows
   that have the same point are neighbours; they are kept as ranges, cut by the distance from
   window to point, so that all windows of a range share ``GRAM`` words at least.  The hash of
   these is their fingerprint, which equal windows share for certain; another one is made of all
   words.  A window of one word only has no point; the first one of a stretch of them is a range,
   and so are the others, which differ from it in length, as a stretch repeats itself.
   Later copies of a whole text are found before by its hash: all of their windows go.
2. Ranges whose fingerprint occurs once in the corpus repeat nothing.  Most of the
   others are equal from end to end where they share it: all but the first go.
3. Where ranges of one fingerprint differ, the windows of the first of each kind
   are hashed whole and joined with their first position, in the order of doc_id and
   word; those that the same range has in an earlier line of its document go unhashed.  A window that stands at an earlier position too goes; windows that
   overlap or touch make one span, so matches extend both ways as far as they are
   equal.

Windows are matched by their own words, whatever stands around them: a passage
goes also if no single earlier document holds more of it than 50 words.  Counts
and first positions are aggregates and each window is compared with one position
only, so work grows with the text and not with the square of a passage's copies.

Within one document, a window counts as repeated only if its first place starts
in an earlier line, a line being a line of the text or a sentence in it: one word
written a thousand times in a line is no passage that returns.

Defined results: null and empty texts have no words and stay as they are; rows
equal in doc_id and text count as one document; rows that share a doc_id only
are ordered by a hash of the text; a null doc_id is the last; a passage
repeated in one document is deleted from its second position on; white space in
front of a span stays, that behind its last word goes; an empty table gives no
rows.  All other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.llm.common import among, discard, outside, rewritten, settle, small, table, tidied

#: Words that a fingerprint hashes; the windows of a range share them.
GRAM = 26
MIN_WORDS = 50
#: Hashes below which a word has the first rank, one in 24, and the second, one in 8.
BEST, GOOD = -(1 << 63) + (1 << 64) // 24, -(1 << 63) + (1 << 64) // 8
#: Where lines end: behind a line feed, and behind a sentence's mark and white space.
LINE_END = r"(?<=[.!?][ \t\r\f])|(?<=\n)"
WHITE = " \t\r\n\f\x0b"
_LAST = (1 << 63) - 1


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE))


def _words(text: Column) -> Column:
    """The words of a text: split at single blanks, which is cheaper than a pattern, without the empty ones."""
    for c in WHITE[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _codes(text: Column) -> Column:
    """A hash for each word: any run of words is a slice of them, hashed at once."""
    return F.transform(_words(text), lambda w: F.xxhash64(w))


def _run(codes: Column, first: Column, count: Column | int) -> Column:
    """The codes of ``count`` words from number ``first`` on."""
    return F.slice(codes, first + 1, count)


def _with(value: Column | str, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value evaluated once."""
    return F.get(F.transform(F.array(value), use), 0)


def _points(codes: Column, low: Column, high: Column, reach: int, below: int | None = None) -> Column:
    """Numbers of the words low .. high that differ from the next one, where ``reach`` is 1, and have a hash with it that is less than ``below``.

    A word's own hash would make a frequent word a point wherever it stands, and a word that is said again and again
    a point each time.
    """

    def point(i: Column) -> Column:
        here, ahead = F.get(codes, i), F.get(codes, i + 1)
        differs = here != ahead if reach else F.lit(True)
        return differs if below is None else ((here.bitwiseXOR(F.shiftleft(ahead, 1)) if reach else here) < below) & differs

    return F.filter(F.sequence(low, high), point)


def _ranges(points: Column, low: Column, high: Column, span: int) -> Column:
    """Windows low .. high by the first point that they hold: ranges of windows, with the point."""
    each = F.transform(points, lambda p, i: F.struct(F.greatest(F.coalesce(F.get(points, i - 1) + 1, low), p - (span - 1)).alias("first"), F.least(p, high).alias("last"), p.alias("at")))
    return F.filter(each, lambda r: r["first"] <= r["last"])


def _gaps(points: Column, low: Column, high: Column, span: int) -> Column:
    """Windows low .. high that hold no point, as ranges."""
    each = F.transform(
        F.sequence(F.lit(0), F.size(points)),
        lambda i: F.struct(F.coalesce(F.get(points, i - 1) + 1, low).alias("low"), F.least(F.coalesce(F.get(points, i) - span, high), high).alias("high")),
    )
    return F.filter(each, lambda g: g["low"] <= g["high"])


def _each(df: DataFrame, array: Column | str, name: str) -> DataFrame:
    """A row for each element of an array, in place of the column ``name`` if there is one.

    Not by ``explode``: Spark would look first whether the array is empty, in a filter that it
    pushes down, and so make the array twice.
    """
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def fingerprints(units: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM) -> DataFrame:
    """Ranges of windows of documents with enough words: d, first and last window, fingerprint, and hash of all words."""
    words = units.select("d", _codes(F.col("__text")).alias("codes"))
    # No filter by n: Spark would push it down and make the codes twice.
    words = words.withColumn("n", F.size("codes"))
    # A word and the next one are in ``span`` windows together.
    reach = min(1, min_words - 1)
    span = min_words - reach
    low, high = F.lit(0), F.col("n") - min_words
    best = F.when(high >= 0, _with("codes", lambda c: _points(c, low, high + (span - 1), reach, BEST)))
    words = words.withColumn("best", best)
    none = F.array().cast("array<struct<first:int,last:int,at:int>>")
    words = words.withColumns({"ranges": F.coalesce(_ranges(F.col("best"), low, high, span), none), "gaps": F.when(high >= 0, _gaps(F.col("best"), low, high, span))}).drop("best")

    def one_word(g: Column) -> Column:
        """Windows that hold the same word only: the first, and the others."""
        first = F.struct(g["low"].alias("first"), g["low"].alias("last"), g["low"].alias("at"))
        return F.when(g["low"] < g["high"], F.array(first, F.struct((g["low"] + 1).alias("first"), g["high"].alias("last"), g["high"].alias("at")))).otherwise(F.array(first))

    def in_gap(codes: Column, g: Column, below: int | None, rest: Callable[[Column], Column]) -> Column:
        def found(points: Column) -> Column:
            return F.concat(_ranges(points, g["low"], g["high"], span), F.flatten(F.transform(_gaps(points, g["low"], g["high"], span), rest)))

        return _with(_points(codes, g["low"], g["high"] + (span - 1), reach, below), found)

    gaps = _with("codes", lambda c: F.transform("gaps", lambda g: in_gap(c, g, GOOD, lambda r: in_gap(c, r, None, one_word))))
    words = words.withColumn("ranges", F.concat("ranges", F.coalesce(F.flatten(gaps), none))).select("d", "codes", "ranges")
    # Ranges are cut where the distance to their point is a multiple of ``block``, so equal windows stand in blocks
    # of the same distance, and all windows of a block share at least ``gram`` words, which the last of these are
    # hashed of: they hold the point and, as far as its windows go, the next word.
    block = min_words - gram + 1
    cut = _each(words, "ranges", "ranges").select("d", "codes", "ranges.*")
    cut = _each(cut, F.sequence(F.floor((F.col("at") - F.col("last")) / block).cast("int"), F.floor((F.col("at") - F.col("first")) / block).cast("int")), "b")
    end = F.col("at") - F.col("b") * block
    start = F.col("at") - F.least((F.col("b") + 1) * block, F.lit(span)) + block
    cut = cut.select("d", "codes", "at", start.alias("start"), F.greatest("first", end - (block - 1)).alias("first"), F.least("last", end).alias("last"))
    return cut.select(
        "d",
        "first",
        "last",
        F.xxhash64(_run(F.col("codes"), F.col("start"), gram)).alias("h"),
        F.xxhash64(F.col("at") - F.col("first"), _run(F.col("codes"), F.col("first"), F.col("last") - F.col("first") + min_words)).alias("whole"),
    )


def copies(units: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """d of the documents whose whole text an earlier one has."""
    texts = rewritten(units.select("d", F.xxhash64("__text").alias("x")), paths)
    first = settle(texts.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("at")).filter("n > 1").drop("n"))
    return settle(among(texts, first, "x").join(small(first), "x").filter("d <> at").select("d"))


def _joined(ranges: Column) -> Column:
    """Ranges in order, those put together that adjoin each other and are treated alike: first, last, back, hashed."""
    alike = lambda a, b: F.coalesce((a["last"] + 1 == b["first"]) & (a["hashed"] == b["hashed"]) & (a["first"] - a["back"]).eqNullSafe(b["first"] - b["back"]), F.lit(False))

    def joined(rs: Column) -> Column:
        starts = F.filter(rs, lambda r, i: ~alike(F.get(rs, i - 1), r))
        stops = F.filter(rs, lambda r, i: ~alike(r, F.get(rs, i + 1)))
        return F.zip_with(starts, stops, lambda a, b: F.struct(a["first"].alias("first"), b["last"].alias("last"), a["back"].alias("back"), a["hashed"].alias("hashed")))

    return _with(F.array_sort(ranges), joined)


def repeated_windows(units: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, paths: list[str] | None = None, left_out: DataFrame | None = None) -> DataFrame:
    """Windows of ``min_words`` words that an earlier place has: d, first, last, ranges of the numbers of their first words.

    ``units`` has d, the number of a document in their order, and __text; ``left_out`` has
    the d of documents that take no part.  The tables that the result is read from are added to ``paths``.
    """
    spark, passing = units.sparkSession, []
    ranges = rewritten(fingerprints(units if left_out is None else outside(units, left_out, "d"), min_words, gram), passing)
    shared = ranges.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("whole").alias("least"), F.max("whole").alias("most"), F.min("d").alias("at")).filter("n > 1")
    shared = settle(shared.select("h", (F.col("least") < F.col("most")).alias("mixed"), "at"))
    tidied(spark)
    # ``kind``: the same for ranges that are equal from end to end; ``part``: for those of one fingerprint.
    kind = F.when(F.col("mixed"), F.xxhash64("h", "whole")).otherwise(F.col("h")).alias("kind")
    met = rewritten(among(ranges, shared, "h").join(small(shared), "h").select(kind, F.hash("h").alias("part"), "d", "first", "last", "mixed", "at"), paths)
    discard(spark, passing)
    # Ranges of one fingerprint that differ: first documents by all their words.
    mixed = met.filter("mixed").drop("at", "mixed")
    kinds = settle(mixed.groupBy("kind").agg(F.min("d").alias("at")))
    mixed = rewritten(mixed.join(small(kinds), "kind").select("kind", "part", "d", "first", "last", "at"), paths)
    tidied(spark)
    equal = met.filter("NOT mixed").select("kind", "part", "d", "first", "last", "at")
    whole = equal.union(mixed).filter("d <> at").select("d", "first", "last")

    # What is left needs the words: windows of ranges that differ, and repeats within one document, which are
    # compared with the first range of their kind, ``back``.
    own = equal.withColumn("hashed", F.lit(False)).union(mixed.withColumn("hashed", F.lit(True))).filter("d = at").drop("at")
    back = settle(own.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("back")).filter("n > 1").drop("n"))
    rest = own.join(small(back), "kind", "left").withColumn("back", F.when(F.col("first") > F.col("back"), F.col("back"))).filter("hashed OR back IS NOT NULL")
    rest = rest.groupBy("d").agg(F.collect_list(F.struct("first", "last", "back", "hashed", "part")).alias("rest"))
    # Whether the document may repeat itself.
    twice = F.exists("rest", lambda r: r["back"].isNotNull()) | (F.size(F.array_distinct(F.col("rest.part"))) < F.size("rest"))
    rest = rewritten(rest.select("d", _joined(F.col("rest")).alias("rest"), twice.alias("twice")), paths)
    tidied(spark)
    # Where the ranges are too many to broadcast, the documents may not be, so that only their texts are shuffled.
    few = small(rest.select("d"))
    found = units.join(few, "d", "left_semi").join(small(rest, "rest"), "d")
    # The line of each word, where it may.
    by_line = F.transform(F.split("__text", LINE_END), lambda u: _trimmed(u))
    per_word = F.flatten(F.transform(by_line, lambda u, i: F.when(u == "", F.array().cast("array<int>")).otherwise(F.array_repeat(i, F.size(F.split(u, r"\s+"))))))
    found = found.select("d", _codes(F.col("__text")).alias("codes"), "rest", F.when(F.col("twice"), per_word).alias("line"))
    each = _each(found, "rest", "rest").select("d", "codes", "line", "rest.*")

    def later(p: Column) -> Column:
        """Whether the same window of the first range of the kind starts in an earlier line."""
        return F.coalesce(F.get("line", F.col("back") + p - F.col("first")) < F.get("line", p), F.lit(False))

    # A range goes at once if all windows of the first one start before its own line.
    entire = F.coalesce(F.get("line", F.col("back") + F.col("last") - F.col("first")) < F.get("line", F.col("first")), F.lit(False))
    each = each.withColumn("entire", entire)
    each = _each(each, F.when(F.col("entire"), F.array("first")).otherwise(F.sequence("first", "last")), "p").withColumn("later", later(F.col("p"))).filter("hashed OR later")
    line, h = F.coalesce(F.get("line", F.col("p")), F.lit(0)), F.xxhash64(_run(F.col("codes"), F.col("p"), min_words))
    windows = rewritten(each.select("d", "p", F.when(F.col("entire"), F.col("last")).otherwise(F.col("p")).alias("q"), F.when(~F.col("later"), line).alias("line"), F.when(~F.col("later"), h).alias("h")), paths)
    tidied(spark)
    hashed = windows.filter("h IS NOT NULL").drop("q")
    # Not the least struct of d and line, which Spark aggregates by sorting: the line of the first place is asked for
    # only where a document has lines at all.
    first = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("at"), F.max("line").alias("top")).filter("n > 1").drop("n")
    first = settle(first)
    tidied(spark)
    # First places themselves go no further, where there are no lines.
    met = rewritten(among(hashed, first, "h").join(small(first), "h").filter("d <> at OR top > 0").withColumn("other", F.col("d") != F.col("at")).drop("at", "top"), paths)
    tidied(spark)
    within = met.filter("NOT other")
    lines = settle(within.groupBy("h").agg(F.min("line").alias("low"), F.max("line").alias("high")).filter("low < high").drop("high"))
    again = met.filter("other").select("d", "p").union(within.join(small(lines), "h").filter("line > low").select("d", "p"))
    return whole.union(windows.filter("h IS NULL").select("d", F.col("p").alias("first"), F.col("q").alias("last"))).union(again.select("d", F.col("p").alias("first"), F.col("p").alias("last")))


def _merged(windows: DataFrame, min_words: int) -> DataFrame:
    """Spans of words, put together where windows overlap or touch: d, ``bounds`` with start and end in turn."""
    ranges = windows.groupBy("d").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("rs"))
    starts = F.filter("rs", lambda r, i: (i == 0) | (F.get("rs", i - 1)["last"] + min_words < r["first"]))
    stops = F.filter("rs", lambda r, i: (i == F.size("rs") - 1) | (F.get("rs", i + 1)["first"] > r["last"] + min_words))
    both = F.flatten(F.zip_with(starts, stops, lambda a, b: F.array(a["first"], b["last"] + min_words)))
    return ranges.select("d", both.alias("bounds"))


def _numbered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """With ``d``, the number of a document in their order: doc_id, null last, and where rows share one, a hash of the text; and whether rows do share one."""
    docs = docs.withColumn("d", F.coalesce(F.col("__id").cast("long"), F.lit(_LAST)))
    if not docs.groupBy("d").count().filter("count > 1").limit(1).count():
        return docs, False
    docs = docs.withColumnRenamed("d", "k").withColumn("x", F.xxhash64("__text"))
    # The order of a sorted table's rows; rows equal in both count once.
    order = settle(docs.select("k", "x").distinct().orderBy("k", "x").select("k", "x", F.monotonically_increasing_id().alias("d")))
    return docs.join(small(order), ["k", "x"]).drop("k", "x"), True


def without_runs(df: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS, gram: int = GRAM, removed: str = "removed") -> DataFrame:
    """``df`` with later repeats deleted from ``text``; adds ``removed``, structs of character start and end in the old text, in place of a column of that name."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text])
    plain = df.select(row.alias("__row"), F.col(f"`{text}`").cast("string").alias("__text"), F.col(f"`{doc_id}`").alias("__id"))
    docs, several = _numbered(plain)
    units = docs.filter(F.length("__text") >= 2 * min_words - 1).select("d", "__text")
    if several and units.groupBy("d").count().filter("count > 1").limit(1).count():
        units = units.dropDuplicates(["d"])
    paths: list[str] = []
    again = copies(units, paths)
    bounds = _merged(repeated_windows(units, min_words, gram, paths, again), min_words)
    # No bounds: all words.
    bounds = settle(bounds.union(again.select("d", F.array().cast("array<int>"))))
    discard(df.sparkSession, paths)
    tidied(df.sparkSession)
    marked = docs.join(small(bounds, "bounds"), "d", "left").drop("d", "__id")
    # Words with the white space behind them; what stands in front of the first word is one of them, too.
    marked = marked.withColumn("tokens", F.when(F.size("bounds") > 0, F.split("__text", r"(?<=\s)(?=\S)")))
    ahead = F.when(_trimmed(F.get("tokens", F.lit(0))) == "", 1).otherwise(0)
    marked = marked.withColumn("cuts", F.concat(F.array(F.lit(0)), F.transform("bounds", lambda b: b + ahead), F.array(F.size("tokens"))))
    pieces = F.transform(
        F.slice("cuts", 2, F.size("cuts")),
        lambda stop, i: F.array_join(F.slice("tokens", F.get("cuts", i) + 1, stop - F.get("cuts", i)), ""),
    )
    # A copy of fewer words has no window.
    copied = F.size(_words(F.col("__text"))) >= min_words
    body = F.ltrim("__text", F.lit(WHITE))
    whole = F.array(F.left("__text", F.length("__text") - F.length(body)), body, F.lit(""))
    marked = marked.withColumn("pieces", F.when(F.size("bounds") > 0, pieces).when(F.col("bounds").isNotNull(), F.when(copied, whole))).drop("tokens", "cuts")
    ends = F.aggregate("pieces", F.array(F.lit(0)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.length(p))))
    kept = F.coalesce(F.array_join(F.filter("pieces", lambda p, i: i % 2 == 0), ""), F.col("__text"))
    marked = marked.withColumns({"ends": ends, "kept": kept})
    spans = F.transform(F.sequence(F.lit(1), F.size("ends") - 3, F.lit(2)), lambda i: F.struct(F.get("ends", i).alias("start"), F.get("ends", i + 1).alias("stop")))
    gone = F.when(F.col("ends").isNull(), F.array().cast("array<struct<start:int,stop:int>>")).otherwise(spans)
    rest = [F.col(f"__row.`{c}`") for c in df.columns if c not in (text, removed)]
    return marked.select(*rest, F.col("kept").alias(text), gone.alias(removed))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of 50 words and more that an earlier one has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_runs(docs).select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), "removed")
