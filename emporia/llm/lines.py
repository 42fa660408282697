"""Line dedup with a suffix array over sequences of line ids.

Every row is a sequence of line ids (hashes of its lines, blank ones left out).  The
suffix array is built by prefix doubling: a suffix's rank is the number of suffixes
with smaller first ``length`` lines, and its rank with the one of the suffix ``length``
lines on orders twice as many lines.  Suffixes of one rank are an interval with a
longest common prefix of at least ``length`` lines.  The first of them in document
order is the original; what the others share with it are later copies.

Only suffixes that still share their rank are refined.  Ranks are running sums over
range partitions of the order, which also cut a hot rank, and all counts are partial
aggregates, so a very common line costs a row a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.scratch import stored

ROW = ["doc_id", "tag"]
BLANKS = " \t\r\f\x0b"


def tagged(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, text); the tag, the text's hash, tells rows apart that share a doc_id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tag"), "text")


def line_ids(rows: DataFrame) -> DataFrame:
    """(doc_id, tag, at, left, h): the lines of ``rows`` that are not blank, ``at`` their
    place in the row's sequence, ``left`` how many lines it has from there on.

    A line ends at a line feed; blanks at its ends count for nothing.  Rows equal in
    doc_id and text are one sequence; a null doc_id has none.
    """
    cut = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)))
    full = rows.where("doc_id is not null").select(*ROW, F.filter(cut, lambda x: x != "").alias("lines"))
    lines = full.select(*ROW, F.size("lines").alias("total"), F.posexplode("lines").alias("at", "line"))
    return lines.select(*ROW, "at", (F.col("total") - F.col("at")).alias("left"), F.xxhash64("line").alias("h")).distinct()


def running(counts: DataFrame, keys: list[str]) -> DataFrame:
    """``counts`` (keys, n) with before: the sum of n over all smaller keys."""
    parts = stored(counts.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "counts")
    inside = F.sum("n").over(Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1))
    earlier = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.groupBy("_part").agg(F.sum("n").alias("_n")).select("_part", F.coalesce(earlier, F.lit(0)).alias("_before"))
    return parts.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(offsets, "_part").withColumn("before", F.col("_inside") + F.col("_before")).drop("_part", "_inside", "_before")


def suffix_intervals(lines: DataFrame) -> DataFrame:
    """(length, doc_id, tag, at, rank, later) for length 1, 2, 4, ...: suffixes that share
    their first ``length`` lines with another, their rank, and whether one of the same
    rank stands before.  ``lines`` is what ``line_ids`` returns, stored."""
    first = running(lines.groupBy("h").agg(F.count("*").alias("n")), ["h"])
    suffixes = stored(lines.join(first, "h").select(*ROW, "at", "left", F.col("before").alias("rank"), (F.col("n") > 1).alias("open")), "suffixes")
    found, length = None, 1
    while True:
        level = suffixes.where("open")
        # Equal ranks with this many lines left have all of them in common.
        # Written, so that the join's sides are plain shuffles and a hot rank can be split.
        originals = stored(level.groupBy("rank").agg(F.min(F.struct("doc_id", "at", "tag")).alias("original")), "originals")
        marked = stored(
            level.join(originals, "rank").select(F.lit(length).alias("length"), *ROW, "at", "rank", (F.struct("doc_id", "at", "tag") > F.col("original")).alias("later")),
            "intervals",
        )
        found = marked if found is None else found.union(marked)
        if marked.isEmpty():
            return found
        # A suffix that ends here comes first in its interval; one with too few lines for
        # twice the length is done.
        on = suffixes.select(*ROW, (F.col("at") - length).alias("at"), F.col("rank").alias("next"))
        pairs = stored(level.select(*ROW, "at", "left", "rank").join(on, [*ROW, "at"], "left").withColumn("next", F.coalesce("next", F.lit(-1))), "pairs")
        sums = running(pairs.groupBy("rank", "next").agg(F.count("*").alias("n")), ["rank", "next"])
        start = sums.groupBy("rank").agg(F.min("before").alias("start"))
        refined = sums.join(start, "rank").select("rank", "next", (F.col("rank") + F.col("before") - F.col("start")).alias("new"), (F.col("n") > 1).alias("open"))
        renewed = pairs.join(refined, ["rank", "next"]).select(*ROW, "at", "left", F.col("new").alias("rank"), (F.col("open") & (F.col("left") >= 2 * length)).alias("open"))
        suffixes, length = stored(suffixes.where("not open").union(renewed), "suffixes"), 2 * length


def _assemble(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs, alone, longest in zip(*(batch.column(c).to_pylist() for c in ("text", "runs", "alone", "longest")), strict=True):
                lines = (text or "").split("\n")
                full = [bool(x.strip(BLANKS)) for x in lines]
                drop, single, only = set(runs or ()), set(alone or ()), sum(full) == 1
                at, gone, kept = 0, 0, []
                for line, counts in zip(lines, full, strict=True):
                    if counts and (at in drop or at in single and (only or len(line.encode().split()) >= min_words)):
                        gone += 1
                    else:
                        kept.append(line)
                    at += counts
                out.append((at, gone, longest or 0, "\n".join(kept)))
            counts = [pa.array([x[k] for x in out], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array([x[3] for x in out], pa.string())], names=["doc_id", "n_lines", "n_removed", "longest_shared", "kept"])

    return run


def drop_line_copies(docs: DataFrame, min_lines: int = 2, min_words: int = 3) -> DataFrame:
    """(doc_id, n_lines, n_removed, longest_shared, kept) for every row of ``docs``
    (doc_id, text).

    A line goes if it also stands at an earlier place (in a smaller doc_id, or before in
    the same one) and lies in a run of at least ``min_lines`` lines (a power of two) that
    does, or has at least ``min_words`` words, or is its text's only line: short lines
    such as headings or brackets between other neighbours stay.  Blank lines are no part
    of runs and stay.  ``longest_shared`` is the largest power of two of lines that an
    earlier place shares.  A null text has no lines; a row with a null doc_id keeps all
    lines and takes no part; rows equal in doc_id and text are handled alike.  Other
    columns are not read.
    """
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    rows = tagged(docs)
    lines = stored(line_ids(rows), "lines")
    later = suffix_intervals(lines).where("later")
    gone = later.where(F.col("length").isin(1, min_lines)).select(
        *ROW, "length", F.explode(F.when(F.col("length") == min_lines, F.sequence("at", F.col("at") + min_lines - 1)).otherwise(F.array("at"))).alias("at")
    )
    gone = gone.groupBy(*ROW).agg(
        F.collect_set(F.when(F.col("length") == min_lines, F.col("at"))).alias("runs"), F.collect_set(F.when(F.col("length") == 1, F.col("at"))).alias("alone")
    )
    longest = later.groupBy(*ROW).agg(F.max("length").alias("longest"))
    full = rows.join(longest.join(gone, ROW, "left"), ROW, "left")
    return full.select("doc_id", "text", "runs", "alone", "longest").mapInArrow(_assemble(min_words), "doc_id long, n_lines long, n_removed long, longest_shared long, kept string")
