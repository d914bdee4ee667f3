"""Removal of repeated passages by content-defined chunks of lines, with DataFrame functions only.

A line's frequency is the number of its occurrences in the whole table, found
by its 64-bit hash.  Within a document the repeated lines (frequency two or
more) form chunks.  A chunk ends

- before a line that occurs once,
- where the frequency changes between neighbouring lines (a passage that was
  pasted as a whole has one frequency, its surroundings have others), and
- after a line where the rolling hash over the last two line hashes of the
  run is 0 modulo ``DIVISOR``.

These rules look at the content only, so a passage is cut alike wherever it
stands.  Of equal chunks the first (least document, then line) stays.  A later
one is a candidate; its text is compared byte by byte with the first one's.
Neighbouring equal chunks form a block, and blocks of ``MIN_WORDS`` words or
more are removed; shorter repetitions (a common short line) stay.

A passage's outer chunks depend on the frequencies around it, so a second pass
compares what the chunks leave by windows of lines: at each line with words the
shortest window of ``MIN_WORDS`` words that starts there, and the shortest one
that ends there.  They depend on the passage only and cover it, so every run of
lines of ``MIN_WORDS`` words that stands earlier as a whole is found (from its
first to its last line with words).  Neighbouring windows with one first
occurrence are joined, compared byte by byte and removed.

Hot lines and chunks are counted with partial aggregates, and joins on their
hashes can be split by the adaptive optimizer.  No window holds more than one
document's repeated lines.

Every row has a place in the order: rows whose ``doc_id`` is their own come
first, by it; then rows that share their ``doc_id`` with others, by it and their
text, then rows without one, by their text.  The latter two are written once and
numbered after the largest id.

Nulls: a null text stays null.  Empty texts and tables pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewise.llm.common import free_name, materialize

MIN_WORDS = 40
DIVISOR = 4
#: Small sides are sent to every task up to this many rows and lines; beyond that the join is shuffled.
BROADCAST_ROWS = 1_000_000
BROADCAST_LINES = 4_000_000


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once per row however often a lambda inside ``body`` reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_place(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of its own for every row, and that column's name; see the order above."""
    place, other = free_name("place", docs), free_name("shared_id", docs)
    own = F.col("doc_id").cast("long")
    counts = docs.groupBy(own.alias(other)).agg(F.count(F.lit(1)).alias("n")).filter(F.col(other).isNull() | (F.col("n") > 1))
    shared = materialize(counts.select(other), "line-shared")
    if shared.isEmpty():
        return docs.withColumn(place, own), place
    alone = docs.filter("doc_id is not null").join(shared, own == F.col(other), "left_anti")
    rest = docs.join(shared, own.eqNullSafe(F.col(other)), "left_semi")
    at = free_name("row_at", docs)
    ordered = rest.withColumn(at, F.monotonically_increasing_id()).orderBy(own.asc_nulls_last(), F.col("text").asc_nulls_first(), at).drop(at)
    stored = materialize(ordered, "line-shared-ids")
    name, number = (stored.metadataColumn("_metadata")[c] for c in ("file_name", "row_index"))
    file, before = free_name("in_file", docs), free_name("rows_before", docs)
    stored = stored.select("*", name.alias(file), number.alias(place))
    rows_of = stored.groupBy(file).agg(F.count(F.lit(1)).alias("n"))  # a row per file of the sort
    run = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    rows_of = rows_of.select(file, F.coalesce(F.sum("n").over(run), F.lit(0)).alias(before))
    ends = alone.agg(F.min(own), F.max(own)).first()
    n = stored.count()
    if ends[1] is None or ends[1] < (1 << 63) - 1 - n:
        base = 0 if ends[1] is None else ends[1] + 1
    elif ends[0] >= n - (1 << 63):
        base = ends[0] - n  # no room above: they come first
    else:
        raise ValueError("doc_id leaves no numbers for the rows that share an id or have none")
    numbered = stored.join(F.broadcast(rows_of), file).withColumn(place, F.col(place) + F.col(before) + F.lit(base)).drop(file, before)
    return alone.withColumn(place, own).unionByName(numbered), place


def word_count(line: Column) -> Column:
    """Number of space-separated words of a line."""
    return F.size(F.filter(F.split(line, " "), lambda w: w != ""))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, h, words, df): the lines that occur more than once, ``h`` their hash."""
    lines = docs.filter("text is not null").select(
        "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    thin = lines.select("doc_id", "pos", F.xxhash64("line").alias("h"), word_count(F.col("line")).cast("int").alias("words"))
    frequency = (lines.select(F.xxhash64("line").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"))
    return thin.join(frequency, "h").select("doc_id", "pos", "h", "words", "df")


def repeated_chunks(seen: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """(doc_id, first, last, words, chunk): chunks of repeated lines; ``chunk`` hashes the line hashes."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    near = (F.lag("pos").over(w) == F.col("pos") - 1) & (F.lag("df").over(w) == F.col("df"))
    seen = seen.withColumn("near", F.coalesce(near, F.lit(False))).withColumn("h1", F.lag("h").over(w))
    rolled = F.when(F.col("near"), F.xxhash64("h1", "h")).otherwise(F.xxhash64("h"))
    seen = seen.withColumn("cut", F.pmod(rolled, F.lit(divisor)) == 0)
    starts = ~F.col("near") | F.coalesce(F.lag("cut").over(w), F.lit(True))
    seen = seen.withColumn("number", F.sum(starts.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    in_order = F.array_sort(F.collect_list(F.struct("pos", "h")))
    return seen.groupBy("doc_id", "number").agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.sum("words").alias("words"),
        F.xxhash64(F.transform(in_order, lambda x: x["h"])).alias("chunk")).drop("number")


def repeated_runs(seen: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, start, hashes, worded): runs of neighbouring repeated lines, of ``min_words`` words or more.

    ``worded`` has the lines with words: index in the run, words, and words up to and with the line.
    """
    w = Window.partitionBy("doc_id").orderBy("pos")
    runs = seen.withColumn("run", F.col("pos") - F.row_number().over(w))
    so_far = Window.partitionBy("doc_id", "run").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.withColumn("total", F.sum("words").over(so_far))
    runs = runs.groupBy("doc_id", "run").agg(F.min("pos").alias("start"), F.sum("words").alias("all"), F.array_sort(
        F.collect_list(F.struct("pos", "h", "words", "total"))).alias("lines")).filter(F.col("all") >= min_words)
    worded = F.filter(F.col("lines"), lambda x: x["words"] > 0)
    return runs.select("doc_id", "start", F.transform("lines", lambda x: x["h"]).alias("hashes"), F.transform(
        worded, lambda x: F.struct((x["pos"] - F.col("start")).alias("i"), x["words"].alias("words"), x["total"].alias("total"))).alias("worded"))


def shortest_windows(runs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, first, last, chunk): the shortest windows of ``min_words`` words that start or end at each line with words.

    ``runs`` is a stored table, so its arrays are not built anew for each element.  A window has at
    most ``min_words`` lines with words, which bounds both searches.
    """
    worded = F.col("worded")

    def pair(a, z):  # one number, so that the union of both lists is by hashing
        return F.shiftleft(a.cast("long"), 32).bitwiseOR(z.cast("long"))

    def forward(x, k):
        ends = F.filter(F.slice(worded, k + 1, F.lit(min_words)), lambda y: y["total"] >= x["total"] - x["words"] + min_words)
        return pair(x["i"], F.get(ends, F.lit(0))["i"])

    def backward(x, k):
        back = F.slice(worded, F.greatest(k + 2 - min_words, F.lit(1)), F.least(k + 1, F.lit(min_words)))
        begins = F.filter(back, lambda y: y["total"] - y["words"] <= x["total"] - min_words)
        return pair(F.try_element_at(begins, F.lit(-1))["i"], x["i"])

    both = F.array_union(F.transform(worded, forward), F.transform(worded, backward))
    whole = F.transform(F.filter(both, lambda x: x.isNotNull()), lambda x: F.struct(
        F.shiftright(x, 32).cast("int").alias("a"), x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("z")))
    hashed = F.transform(whole, lambda x: F.struct(
        (F.col("start") + x["a"]).alias("first"), (F.col("start") + x["z"]).alias("last"),
        F.xxhash64(F.slice("hashes", x["a"] + 1, x["z"] - x["a"] + 1)).alias("chunk")))
    return runs.select("doc_id", F.inline(hashed))


def window_candidates(windows: DataFrame, removed: DataFrame) -> DataFrame:
    """Joined later windows and their first occurrence, but for those within one of ``removed`` (doc_id, first, last)."""
    firsts = windows.groupBy("chunk").agg(F.min(F.struct("doc_id", "first", "last")).alias("at"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = windows.join(firsts, "chunk").select("doc_id", "first", "last", F.col("at.doc_id").alias("o_doc"),
                                                 F.col("at.first").alias("o_first"), F.col("at.last").alias("o_last"))
    # a window over its own first occurrence (one line again and again) is no copy
    later = later.filter("doc_id <> o_doc or first > o_last")
    w = Window.partitionBy("doc_id", "o_doc", "shift").orderBy("first", "last")
    later = later.withColumn("shift", F.col("first") - F.col("o_first"))
    reached = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    later = later.withColumn("starts", F.coalesce((F.col("first") > reached + 1).cast("int"), F.lit(1)))
    later = later.withColumn("number", F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    joined = later.groupBy("doc_id", "o_doc", "shift", "number").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.min("o_first").alias("o_first"), F.max("o_last").alias("o_last"))
    blocks = removed.select(F.col("doc_id").alias("r_doc"), F.col("first").alias("r_first"), F.col("last").alias("r_last"))
    left = joined.join(blocks, (F.col("doc_id") == F.col("r_doc")) & (F.col("r_first") <= F.col("first")) & (F.col("r_last") >= F.col("last")), "left_anti")
    return left.select("doc_id", "first", "last", F.lit(0).alias("words"), F.concat_ws(":", "o_doc", "o_first", "o_last").alias("chunk"),
                       "o_doc", "o_first", "o_last")


def text_of(lines: Column, first: Column, last: Column) -> Column:
    return F.array_join(F.slice(lines, first + 1, last - first + 1), "\n")


def removed_ranges(docs: DataFrame, min_words: int = MIN_WORDS, divisor: int = DIVISOR) -> DataFrame:
    """(doc_id, first, last): disjoint ranges of the lines to remove, after the byte comparison; ``doc_id`` is each row's own."""
    seen = materialize(repeated_lines(docs), "line-repeated")
    chunks = materialize(repeated_chunks(seen, divisor), "line-chunks")
    firsts = chunks.groupBy("chunk").agg(F.min(F.struct("doc_id", "first", "last")).alias("at"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = firsts.select("chunk", F.col("at.doc_id").alias("o_doc"), F.col("at.first").alias("o_first"), F.col("at.last").alias("o_last"))
    later = chunks.join(firsts, "chunk").filter("not (doc_id = o_doc and first = o_first)")
    later = later.select("doc_id", "first", "last", "words", "chunk", "o_doc", "o_first", "o_last")
    later = materialize(_in_blocks(later, min_words), "line-candidates")
    kept = materialize(_in_blocks(equal_to_first(docs, later), min_words).select("doc_id", "first", "last"), "line-blocks")

    runs = materialize(repeated_runs(seen, min_words), "line-runs")
    windows = materialize(shortest_windows(runs, min_words), "line-windows")
    rest = materialize(window_candidates(windows, _joined(kept)), "line-rest")
    return _joined(kept.unionByName(equal_to_first(docs, rest).select("doc_id", "first", "last")))


def removals(docs: DataFrame, min_words: int = MIN_WORDS, divisor: int = DIVISOR) -> DataFrame:
    """(doc_id, gone): the numbers of the lines to remove."""
    found = removed_ranges(docs, min_words, divisor).groupBy("doc_id")
    return found.agg(F.flatten(F.collect_list(F.sequence("first", "last"))).alias("gone"))


def equal_to_first(docs: DataFrame, later: DataFrame) -> DataFrame:
    """(doc_id, first, last, words) of the rows of ``later`` whose text is their first occurrence's."""
    # the first occurrence's text travels to each candidate's document; one exchange of the texts serves both sides
    texts = docs.select("doc_id", "text")
    ids = materialize(later.select("doc_id").unionByName(later.select(F.col("o_doc").alias("doc_id"))).distinct(), "line-ids")
    if ids.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(ids), "doc_id", "left_semi")
    wanted = later.select(F.col("o_doc").alias("w_doc"), "chunk", "o_first", "o_last").distinct().groupBy("w_doc").agg(
        F.collect_list(F.struct("chunk", "o_first", "o_last")).alias("asked"))
    split = F.split("text", "\n", -1)
    passages = let(split, lambda lines: F.transform("asked", lambda x: F.struct(
        x["chunk"].alias("chunk"), text_of(lines, x["o_first"], x["o_last"]).alias("original"))))
    originals = texts.join(wanted, F.col("doc_id") == F.col("w_doc")).select(F.inline(passages))
    originals = originals.groupBy("chunk").agg(F.min("original").alias("original"))
    asked = later.join(originals, "chunk").groupBy(F.col("doc_id").alias("l_doc")).agg(
        F.collect_list(F.struct("first", "last", "words", "original")).alias("asked"))
    same = let(split, lambda lines: F.transform(
        F.filter("asked", lambda x: text_of(lines, x["first"], x["last"]) == x["original"]),
        lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last"), x["words"].alias("words"))))
    return texts.join(asked, F.col("doc_id") == F.col("l_doc")).select("doc_id", F.inline(same)).distinct()


def _joined(ranges: DataFrame) -> DataFrame:
    """(doc_id, first, last) of the unions of touching or overlapping ranges."""
    w = Window.partitionBy("doc_id").orderBy("first", "last")
    reached = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = ranges.withColumn("starts", F.coalesce((F.col("first") > reached + 1).cast("int"), F.lit(1)))
    numbered = starts.withColumn("block", F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("doc_id", "block").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("block")


def _in_blocks(chunks: DataFrame, min_words: int) -> DataFrame:
    """The chunks that lie in a block, a run of neighbouring chunks, of at least ``min_words`` words."""
    w = Window.partitionBy("doc_id").orderBy("first")
    starts = F.coalesce((F.lag("last").over(w) + 1 != F.col("first")).cast("int"), F.lit(1))
    numbered = chunks.withColumn("block", F.sum(starts).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    total = F.sum("words").over(Window.partitionBy("doc_id", "block"))
    return numbered.withColumn("block_words", total).filter(F.col("block_words") >= min_words).drop("block", "block_words")


def cut_ranges(ranges: DataFrame) -> DataFrame:
    """(doc_id, gone, kept, tail): per document how many lines go, the ranges (start, n) of lines before each cut, and the line after the last."""
    w = Window.partitionBy("doc_id").orderBy("first")
    before = F.coalesce(F.lag("last").over(w) + 1, F.lit(0))
    gaps = ranges.select("doc_id", "first", "last", before.alias("start"))
    return gaps.groupBy("doc_id").agg(
        F.sum(F.col("last") - F.col("first") + 1).alias("gone"),
        F.array_sort(F.collect_list(F.struct(F.col("start"), (F.col("first") - F.col("start")).alias("n")))).alias("kept"),
        (F.max("last") + 1).alias("tail"))


def apply_removals(docs: DataFrame, ranges: DataFrame, key: str, count: str = "removed_lines") -> DataFrame:
    """``docs`` with the ranges of its rows ``key`` cut out of ``text``, and ``count``, how many lines they were."""
    doc, gone, kept, tail = (free_name(f"cut_{c}", docs) for c in ("doc", "gone", "kept", "tail"))
    cut = materialize(cut_ranges(ranges), "line-cuts").select(
        F.col("doc_id").alias(doc), F.col("gone").alias(gone), F.col("kept").alias(kept), F.col("tail").alias(tail))
    size = cut.agg(F.count(F.lit(1)), F.sum(F.size(kept))).first()
    if size[0] <= BROADCAST_ROWS and (size[1] or 0) <= BROADCAST_LINES:
        cut = F.broadcast(cut)
    joined = docs.join(cut, F.col(key) == F.col(doc), "left")
    left = let(F.split("text", "\n", -1), lambda lines: F.array_join(F.concat(
        F.flatten(F.transform(kept, lambda x: F.slice(lines, x["start"] + 1, x["n"]))),
        F.slice(lines, F.col(tail) + 1, F.greatest(F.size(lines) - F.col(tail), F.lit(0)))), "\n"))
    text = F.when(F.col(doc).isNull(), F.col("text")).otherwise(left)
    return joined.withColumn("text", text).withColumn(count, F.coalesce(F.col(gone), F.lit(0)).cast("int")).drop(doc, gone, kept, tail)


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, divisor: int = DIVISOR) -> DataFrame:
    """doc_id, text and removed_lines of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows, place = with_place(rows)
    ranges = removed_ranges(rows.select(F.col(place).alias("doc_id"), "text"), min_words, divisor)
    return apply_removals(rows, ranges, place).drop(place)


def drop_repeated(docs: DataFrame, min_words: int = MIN_WORDS, divisor: int = DIVISOR) -> DataFrame:
    """The documents, all columns, without repeated passages; documents of which nothing is left go.

    ``n_chars`` follows the text where the column exists.
    """
    rows, place = with_place(docs)
    ranges = removed_ranges(rows.select(F.col(place).alias("doc_id"), F.col("text").cast("string").alias("text")), min_words, divisor)
    count = free_name("removed_lines", rows)
    found = apply_removals(rows, ranges, place, count).filter((F.col(count) == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.col(count) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return found.select(docs.columns)
