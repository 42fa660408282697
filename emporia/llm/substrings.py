"""Substring dedup by level-wise doubling of repeated windows.

A word window of ``length`` words can only repeat if the half-length windows in it
repeat.  Level one looks at windows of half the length, and of those only at
anchors: the window with the smallest hash among all half-length windows of a full
one, which is the same for equal full windows wherever they stand.  Only full
windows whose anchor repeats are extended to the full length and compared there;
``longer_repeats`` goes on doubling until nothing repeats.

Both levels send hashes by ranges of the hash.  Before that, every batch keeps one place a
hash and answers the others itself, so a passage in a third of all documents costs one
place a batch.  Answered places travel to ranges of their own.  What a batch sends to a
range is one row: sorted hashes as differences, places and documents, compressed.
Texts travel compressed too.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.scratch import stored
from emporia.llm.words import Texts, Words, gram_hashes, mix, slices, word_hashes, words_of

BLOBS = "range int, blob binary"
SLICE = 4_000_000


def pack_places(h: np.ndarray, row: np.ndarray, at: np.ndarray, known: np.ndarray, docs: np.ndarray, tags: np.ndarray) -> bytes:
    """Places (hash, row of ``docs`` and ``tags``, word, answered already) as compressed bytes."""
    by = np.argsort(h, kind="stable")
    h, at, known = h[by], at[by], known[by]
    used, row = np.unique(row[by], return_inverse=True)
    rows, row = np.stack([docs[used], tags[used]]), row.astype(np.uint32)
    # Byte planes: the high bytes of differences and numbers are mostly zero.
    planes = [np.diff(h, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T, row.view(np.uint8).reshape(-1, 4).T, (at * 2 + known).astype(np.uint32).view(np.uint8).reshape(-1, 4).T]
    body = b"".join(np.ascontiguousarray(p).tobytes() for p in planes) + rows.astype(np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<QQ", len(h), rows.shape[1]) + body)


def unpack_places(blob: bytes) -> tuple[np.ndarray, ...]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    n, m = struct.unpack_from("<QQ", body)

    def plane(start: int, width: int, kind: type) -> np.ndarray:
        return np.ascontiguousarray(np.frombuffer(body, np.uint8, n * width, 16 + n * start).reshape(width, n).T).view(kind).reshape(-1)

    h, row, at = np.cumsum(plane(0, 8, np.uint64), dtype=np.uint64), plane(8, 4, np.uint32), plane(12, 4, np.uint32)
    doc, tag = np.frombuffer(body, np.int64, 2 * m, 16 + 16 * n).reshape(2, m)
    return h, doc[row], tag[row], (at >> 1).astype(np.int64), (at & 1).astype(bool)


def _places(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, ...] | None:
    parts = [unpack_places(b) for batch in batches for b in batch.column("blob").to_pylist()]
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True)) if parts else None


def _send(h: np.ndarray, row: np.ndarray, at: np.ndarray, known: np.ndarray, docs: np.ndarray, tags: np.ndarray, ranges: int) -> pa.RecordBatch:
    """One row a range of the hash; answered places go by document and word, so that they
    don't gather."""
    key = np.where(known, mix(docs[row].astype(np.uint64) * np.uint64(31) + at.astype(np.uint64)), h)
    to = ((key >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
    by = np.argsort(to, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(to[by]) != 0)) if len(by) else by
    blobs = [pack_places(h[i], row[i], at[i], known[i], docs, tags) for i in np.split(by, cuts[1:])] if len(by) else []
    return pa.RecordBatch.from_arrays([pa.array(to[by][cuts], pa.int32()), pa.array(blobs, pa.binary())], names=["range", "blob"])


def pack_texts(rows: DataFrame) -> DataFrame:
    """(doc_id, tag, packed) of (doc_id, tag, text); a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            packed = [packer.compress(t.as_py()) if t.is_valid else None for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), pa.array(packed, pa.binary())], names=["doc_id", "tag", "packed"])

    return rows.mapInArrow(run, "doc_id long, tag long, packed binary")


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of a batch, about ``SLICE`` bytes at a time."""
    unpacker = zstandard.ZstdDecompressor()
    first, held, size = 0, [], 0
    for k, x in enumerate(batch.column("packed")):
        held.append(unpacker.decompress(x.as_py()) if x.is_valid else b"")
        size += len(held[-1])
        if size >= SLICE or k == batch.num_rows - 1:
            yield first, held
            first, held, size = k + 1, [], 0


def window_anchors(texts: Texts, words: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word of every full window, its anchor's first word, half-length hashes)."""
    half = (length + 1) // 2
    grams = gram_hashes(hashes, half)
    span = length - half + 1
    count = max(0, len(hashes) - length + 1)
    least, anchor = grams[:count].copy(), np.arange(count)
    for j in range(1, span):
        lower = grams[j : j + count] < least
        least[lower] = grams[j : j + count][lower]
        anchor[lower] = np.flatnonzero(lower) + j
    owner = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    fits = np.arange(count) + length <= words.bounds[1:][owner[:count]]
    windows = np.flatnonzero(fits)
    return windows, anchor[windows], grams


def _first_of(h: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by hash and ``order``: the sorting, and where each run of a hash begins for each row."""
    by = np.lexsort((order, h))
    new = np.ones(len(h), bool)
    new[1:] = h[by][1:] != h[by][:-1]
    run = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    return by, run


def _runs(first: np.ndarray) -> np.ndarray:
    """For each row, the last row of its run."""
    ends = np.flatnonzero(np.append(first[1:] != first[:-1], len(first) > 0))
    return ends[np.searchsorted(ends, np.arange(len(first)))]


def _anchor_places(length: int, ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tag"))
            parts = []
            for t in slices(batch.column("text")):
                w = words_of(t)
                _, anchors, grams = window_anchors(t, w, word_hashes(t, w), length)
                at = np.unique(anchors)
                owner = np.searchsorted(w.bounds, at, side="right") - 1
                parts.append((grams[at], t.first + owner, at - w.bounds[owner]))
            if not parts:
                continue
            h, row, at = map(np.concatenate, zip(*parts, strict=True))
            if not len(h):
                continue
            by, first = _first_of(h, row)
            h, row, at = h[by], row[by], at[by]
            # A hash with two rows of this batch repeats; its first row also asks the others.
            many = row[first] != row[_runs(first)]
            lead = np.flatnonzero(many & (first == np.arange(len(h))))
            known = np.append(many, np.zeros(len(lead), bool))
            known[lead] = False
            known[len(h) :] = True
            both = np.append(np.arange(len(h)), lead)
            yield _send(h[both], row[both], at[both], known, docs, tags, ranges)

    return run


def _window_places(length: int, ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tag"))
            lists = batch.column("ats")
            bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for begin, texts in _unpacked(batch):
                parts = []
                for t in slices(pa.array(texts, pa.large_binary())):
                    w = words_of(t)
                    hashes = word_hashes(t, w)
                    windows, anchors, _ = window_anchors(t, w, hashes, length)
                    n, low = len(t.offsets) - 1, begin + t.first
                    repeats = np.zeros(len(hashes) + 1, bool)
                    own = np.diff(bounds[low : low + n + 1])
                    repeats[values[bounds[low] : bounds[low + n]] + np.repeat(w.bounds[:-1], own)] = True
                    windows = windows[repeats[anchors]]
                    owner = np.searchsorted(w.bounds, windows, side="right") - 1
                    parts.append((gram_hashes(hashes, length)[windows], low + owner, windows - w.bounds[owner]))
                if not parts:
                    continue
                h, row, at = map(np.concatenate, zip(*parts, strict=True))
                if len(h):
                    by, first = _first_of(h, docs[row])
                    h, row, at = h[by], row[by], at[by]
                    yield _send(h, row, at, docs[row] > docs[row[first]], docs, tags, ranges)

    return run


def _answers(doc: np.ndarray, tag: np.ndarray, at: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(tag), pa.array(at.astype(np.int32)), pa.array(h.view(np.int64))], names=["doc_id", "tag", "at", "h"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of a hash that stands in two rows of the table, and places that are known to
    be such.  A place that asks for known ones counts like them."""
    places = _places(batches)
    if places is None:
        return
    h, doc, tag, at, known = places
    # Sorted by doc_id, then tag: a run that begins and ends with one row has no other.
    asks = np.flatnonzero(~known)
    asks = asks[np.lexsort((tag[asks], doc[asks], h[asks]))]
    first = _begins(h[asks])
    last = _runs(first)
    many = (doc[asks[first]] != doc[asks[last]]) | (tag[asks[first]] != tag[asks[last]])
    keep = np.append(np.flatnonzero(known), asks[many])
    yield pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(tag[keep]), pa.array(at[keep].astype(np.int32))], names=["doc_id", "tag", "at"])


def _begins(h: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, for each of the sorted ``h``."""
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(h)), 0)) if len(h) else np.empty(0, np.int64)


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places whose hash also has a smaller doc_id, and places that are known to be such."""
    places = _places(batches)
    if places is None:
        return
    h, doc, tag, at, known = places
    asks = np.flatnonzero(~known)
    asks = asks[np.lexsort((doc[asks], h[asks]))]
    later = asks[doc[asks] > doc[asks[_begins(h[asks])]]] if len(asks) else asks
    keep = np.append(np.flatnonzero(known), later)
    yield _answers(doc[keep], tag[keep], at[keep], h[keep])


ANSWERS = "doc_id long, tag long, at int, h long"
ANCHORS = "doc_id long, tag long, at int"


def tagged(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, text); the tag, the text's hash, tells rows apart that share a doc_id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tag"), "text")


def _ranges(docs: DataFrame) -> int:
    return 3 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def repeated_windows(rows: DataFrame, length: int = 13) -> DataFrame:
    """(doc_id, tag, at, h): windows of ``length`` words, from word ``at`` on, whose words
    also start in a row with a smaller doc_id.  ``rows`` is what ``tagged`` returns."""
    usable, ranges = rows.where("doc_id is not null"), _ranges(rows)
    anchors = usable.mapInArrow(_anchor_places(length, ranges), BLOBS).repartition("range").mapInArrow(_repeated, ANCHORS)
    anchors = anchors.groupBy("doc_id", "tag").agg(F.collect_list("at").alias("ats"))
    # Written, so that what was sent by hash need not be kept for what follows.
    anchors = stored(anchors, "anchors")
    candidates = pack_texts(usable).join(anchors.hint("merge"), ["doc_id", "tag"])
    return candidates.mapInArrow(_window_places(length, ranges), BLOBS).repartition("range").mapInArrow(_later, ANSWERS)


def longer_repeats(windows: DataFrame, length: int = 13) -> DataFrame:
    """(doc_id, tag, at, length): ``windows`` as above, doubled until no candidate
    survives.  Two repeated windows of one row, one straight behind the other, make
    a candidate of twice the length; it survives if another place has the same two."""
    level = stored(windows.select("doc_id", "tag", "at", "h").distinct(), "level")
    found = level.select("doc_id", "tag", "at", F.lit(length).alias("length"))
    while True:
        behind = level.select("doc_id", "tag", (F.col("at") - length).alias("at"), F.col("h").alias("next"))
        twice = stored(level.join(behind, ["doc_id", "tag", "at"]).select("doc_id", "tag", "at", F.xxhash64("h", "next").alias("h")), "level")
        again = twice.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
        level, length = stored(twice.join(again, "h", "left_semi"), "level"), 2 * length
        if level.isEmpty():
            return found
        found = found.union(level.select("doc_id", "tag", "at", F.lit(length).alias("length")))


def _kept(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ats")
            for first, texts in _unpacked(batch):
                out: list[tuple[int, int, str]] = []
                for ats, text in zip(lists[first : first + len(texts)], texts, strict=True):
                    words = text.split()
                    total = len(words)
                    if ats.is_valid and len(ats):
                        change = np.zeros(total + 1, np.int64)
                        at = np.unique(ats.values.to_numpy(zero_copy_only=False))
                        np.add.at(change, at, 1)
                        np.add.at(change, at + length, -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
                    out.append((total, total - len(words), b" ".join(words).decode()))
                counts = [pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[first : first + len(out)], *counts, pa.array([x[2] for x in out], pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return run


def drop_repeats(docs: DataFrame, length: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs`` (doc_id, text).

    A word goes if it lies in a window of ``length`` words that also starts in a row
    with a smaller doc_id, judged on the input; ``kept`` joins the others by one
    space.  Windows within one doc_id never remove each other, so rows that share a
    doc_id keep their words.  A null text has no words; a row with a null doc_id
    takes no part and keeps all words.  Other columns are not read.
    """
    rows = tagged(docs)
    gone = repeated_windows(rows, length).groupBy("doc_id", "tag").agg(F.collect_list("at").alias("ats"))
    return pack_texts(rows).join(stored(gone, "gone").hint("merge"), ["doc_id", "tag"], "left").mapInArrow(_kept(length), "doc_id long, n_words long, n_removed long, kept string")
