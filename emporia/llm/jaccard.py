"""N-gram Jaccard join through count-vector R-trees.

Sets that agree in everything become one.  Linked sets share one of their first
tokens in hash order (as many as the similarity leaves room for), so such a token
is the root of a tree, and an R-tree over the count vectors below it finds which
of its sets may be linked.  What may be linked is connected first; then the
texts of each connected part meet, and exact overlaps decide.

Large trees and parts are cut into blocks; every pair of blocks is a task of its
own.  Inside one, pairs that are connected already are not tested again, so a
group of near copies costs about one test a copy and no list of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.components import components
from emporia.llm.counttree import Overlaps, counts, needed, pack, spanning_links, unpack
from emporia.llm.groups import by_group, in_blocks
from emporia.llm.scratch import stored
from emporia.llm.words import gram_hashes, mix, slices, word_hashes, words_of

BLOCK = 2048

SETS = "doc_id long, n_shingles long, d1 long, d2 long, point binary, head array<long>"


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """By slices, the place of the first text and every text's sorted hashes of distinct
    shingles; with fewer words, one of the whole sequence; without words, none."""
    for t in slices(column, lower=True):
        w = words_of(t)
        hashes = word_hashes(t, w)
        grams = gram_hashes(hashes, shingle)
        sets = []
        for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True):
            if b - a >= shingle:
                sets.append(np.unique(grams[a : b - shingle + 1]))
            else:
                sets.append(gram_hashes(hashes[a:b], b - a) if b > a else np.empty(0, np.uint64))
        yield t.first, sets


def head_lengths(n: int, percent: int) -> tuple[int, int]:
    """How many first tokens the smaller and the larger set of a link must show."""
    return n - int(needed(n, n, percent)) + 1, n - (-(-percent * n // 100)) + 1


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _set_rows(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
        for batch in batches:
            for first, sets in shingle_sets(batch.column("text"), shingle):
                d1 = np.array([np.add.reduce(mix(s ^ one), dtype=np.uint64) for s in sets])
                d2 = np.array([np.add.reduce(mix(s ^ two), dtype=np.uint64) for s in sets])
                heads = [_signed(s[: head_lengths(len(s), percent)[1]] if len(s) else s) for s in sets]
                ends = np.cumsum([0, *map(len, heads)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(_signed(d1)),
                        pa.array(_signed(d2)),
                        pa.array([pack(counts(s)) for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(heads))),
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "point", "head"],
                )

    return run


def _head_rows(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = batch.column("head")
            bounds = heads.offsets.to_numpy()
            sizes, tokens = np.diff(bounds), heads.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]
            n = batch.column("n_shingles").to_numpy()
            small = np.array([head_lengths(int(x), percent)[0] for x in n], np.int64)
            place = np.arange(len(tokens)) - np.repeat(bounds[:-1] - bounds[0], sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens), pa.array(np.repeat(batch.column("doc_id").to_numpy(), sizes)), pa.array(place < np.repeat(small, sizes))],
                names=["token", "doc_id", "early"],
            )

    return run


def _shared_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tree, doc_id) for tokens that two sets show, one of them early.  Tokens that
    are shown by the same sets make one tree."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    table = pa.Table.from_batches(got).combine_chunks()
    token, doc, early = (table.column(c).to_numpy() for c in ("token", "doc_id", "early"))
    by = np.lexsort((doc, token))
    token, doc, early = token[by], doc[by], early[by]
    at = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    size = np.diff(np.append(at, len(token)))
    use = (size > 1) & np.logical_or.reduceat(early, at)
    name = mix(np.add.reduceat(mix(doc.view(np.uint64)), at) + size.astype(np.uint64))
    at, size, name = at[use], size[use], name[use]
    _, first = np.unique(name, return_index=True)
    at, size, name = at[first], size[first], name[first]
    if not len(at):
        return
    rows = np.repeat(at - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    yield pa.RecordBatch.from_arrays([pa.array(_signed(np.repeat(name, size))), pa.array(doc[rows])], names=["tree", "doc_id"])


def _may_link(percent: int):
    def each(group: pa.Table) -> Iterator[tuple]:
        if group.num_rows < 2:
            return
        doc = group.column("doc_id").to_numpy()
        points = [unpack(x) for x in group.column("point").to_pylist()]
        for i, j in spanning_links(points, np.array([p.sum() for p in points]), percent):
            yield int(doc[i]), int(doc[j])

    return each


def _do_link(shingle: int, percent: int):
    def each(group: pa.Table) -> Iterator[tuple]:
        if group.num_rows < 2:
            return
        doc = group.column("doc_id").to_numpy()
        sets = [s for _, part in shingle_sets(group.column("text"), shingle) for s in part]
        sizes = np.array([len(s) for s in sets])
        for i, j in spanning_links([counts(s) for s in sets], sizes, percent, Overlaps(sets, percent)):
            yield int(doc[i]), int(doc[j])

    return each


def jaccard_components(docs: DataFrame, shingle: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    Sets are of ``shingle`` consecutive words, A-Z in lower case; a shorter text is
    one shingle, and a text without words (or null) an empty set, linked with
    nothing.  Sets link when 100 * overlap >= ``percent`` * union.  Rows that share a
    doc_id are one node, which has the links of all its rows.  A row with a null
    doc_id links with nothing and has a null component.  Other columns are not read.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = stored(named.mapInArrow(_set_rows(shingle, percent), SETS), "sets")
    usable = sets.where("doc_id is not null and n_shingles > 0")
    same = ["n_shingles", "d1", "d2"]
    classes = usable.groupBy(*same).agg(F.min("doc_id").alias("rep"))
    member = usable.select("doc_id", *same).join(classes, same).select("doc_id", "rep").distinct()
    reps = stored(usable.join(classes.select(*same, F.col("rep").alias("doc_id")), [*same, "doc_id"], "left_semi").dropDuplicates(["doc_id", *same]), "reps")

    heads = reps.select("doc_id", "n_shingles", "head").mapInArrow(_head_rows(percent), "token long, doc_id long, early boolean")
    trees = stored(heads.repartition("token").mapInArrow(_shared_heads, "tree long, doc_id long").distinct(), "trees")
    # A doc_id with several texts has several points; each stands below the tree.
    placed = in_blocks(trees, "tree", "doc_id", block).join(reps.select("doc_id", "point"), "doc_id")
    maybe = by_group(placed, ["tree", "low", "high"], _may_link(percent), "a long, b long")
    parts = components(maybe).select(F.col("node").alias("doc_id"), F.col("root").alias("part"))

    # The parts grow with the corpus: no broadcast, at any size.
    found = in_blocks(parts, "part", "doc_id", block).hint("merge").join(named, "doc_id")
    links = by_group(found, ["part", "low", "high"], _do_link(shingle, percent), "a long, b long")
    # Classes of equal sets are links too.
    roots = components(links.union(member.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))
    out = sets.select("doc_id", "n_shingles").join(roots.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
