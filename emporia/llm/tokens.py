"""Token ids in seekable binary files.

A shard is a row of independent zstandard frames of ``FRAME`` ids each (the last
may be shorter), then a seek table in the public zstandard seekable format: a
skippable frame with every frame's compressed size, size and checksum, and a
footer.  Reading a document takes the footer, the table and the frames that it
touches.  Shards hold documents in ascending doc_id order, shard after shard.
"""

from __future__ import annotations

import struct
import sys
import types
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.scratch import fresh_folder
from emporia.llm.words import slices, span_hashes

FRAME = 65_536
SLICE = 2_000_000

# Fixed values of the zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

INDEX_SCHEMA = "shard string, part int, width int, doc_id long, at long, n_tokens long"


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class ShardWriter:
    """Writes ids as frames; ``close`` adds the seek table."""

    def __init__(self, path: str, width: int, frame: int = FRAME):
        files, name = open_path(path)
        files.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.out, self.width, self.frame = files.open_output_stream(name, compression=None), width, frame
        self.waiting: list[np.ndarray] = []
        self.held, self.table, self.packer = 0, [], zstandard.ZstdCompressor(level=3)

    def write(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(f"<u{self.width}"))
        self.held += len(ids)
        if self.held >= 16 * self.frame:
            self.flush(self.held - self.held % self.frame)

    def flush(self, upto: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, f"<u{self.width}")
        for at in range(0, upto, self.frame):
            raw = ids[at : min(upto, at + self.frame)].tobytes()
            packed = self.packer.compress(raw)
            self.out.write(packed)
            self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.waiting, self.held = [ids[upto:]], len(ids) - upto

    def close(self) -> None:
        self.flush(self.held)
        body = b"".join(struct.pack("<III", *x) for x in self.table) + struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        self.out.close()


class ShardReader:
    """Reads spans of ids; only the frames that a span touches are decompressed."""

    def __init__(self, path: str, width: int, frame: int = FRAME):
        files, name = open_path(path)
        self.file, self.width, self.frame, self.unpacker = files.open_input_file(name), width, frame, zstandard.ZstdDecompressor()
        end = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError(f"{path} has no seek table with checksums")
        self.table = np.frombuffer(self.file.read_at(12 * count, end - 9 - 12 * count), "<u4").reshape(-1, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        self.last: tuple[int, np.ndarray] = (-1, np.empty(0, f"<u{width}"))

    def load(self, k: int) -> np.ndarray:
        if self.last[0] != k:
            packed, size, check = map(int, self.table[k])
            raw = self.unpacker.decompress(self.file.read_at(packed, int(self.starts[k])), max_output_size=size)
            if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {k} fails its checksum")
            self.last = (k, np.frombuffer(raw, f"<u{self.width}"))
        return self.last[1]

    def read(self, at: int, count: int) -> np.ndarray:
        parts, to = [], at + count
        while at < to:
            k = at // self.frame
            ids = self.load(k)[at - k * self.frame : to - k * self.frame]
            if not len(ids):
                raise ValueError("the span ends beyond the shard")
            parts.append(ids)
            at += len(ids)
        return np.concatenate(parts) if parts else np.empty(0, f"<u{self.width}")

    def close(self) -> None:
        self.file.close()


# A text with one of these is encoded as it stands: they are white space to the
# tokenizer but not to the byte rules below.
_WIDE_SPACE = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80", b"\x1c", b"\x1d", b"\x1e", b"\x1f"]
_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_MARK = np.array([0x20 < b < 0x7F and not chr(b).isalnum() and b != 0x27 for b in range(256)])


class Pieces:
    """Ids of pieces that were encoded before, by hash; at most ``most`` of them."""

    def __init__(self, most: int = 1_000_000):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys, self.begin, self.size, self.ids = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.uint32)

    def find(self, keys: np.ndarray, encode: Callable[[np.ndarray], list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """Begin and size in ``ids`` of each of the sorted ``keys``; ``encode`` is
        given the places of those that are new."""
        if len(self.keys) + len(keys) > self.most:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        todo = np.flatnonzero(new)
        if len(todo):
            lists = encode(todo)
            sizes = np.fromiter(map(len, lists), np.int32, len(lists))
            begin = len(self.ids) + np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)[:-1]])
            self.ids = np.concatenate([self.ids, np.fromiter((x for p in lists for x in p), np.uint32, int(sizes.sum()))])
            self.keys, self.begin, self.size = (np.insert(old, at[todo], more) for old, more in ((self.keys, keys[todo]), (self.begin, begin), (self.size, sizes)))
            at = np.searchsorted(self.keys, keys)
        return self.begin[at], self.size[at].astype(np.int64)


def encode_slice(
    encode: Callable[[list[str]], list[list[int]]],
    data: np.ndarray,
    offsets: np.ndarray,
    seen: Pieces | None = None,
    special: tuple[bytes, ...] = (),
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and where each text's ids begin.

    The tokenizer never joins characters across the place before a single space
    or line break that stands between two characters other than white space, after
    such a line break, or between an ASCII letter and a mark other than the
    apostrophe.  Texts are cut there, each distinct piece is encoded once, and
    pieces are put together again.  Texts with wide white space or one of the
    ``special`` strings are encoded whole.
    """
    n = len(offsets) - 1
    if len(data) == 0:
        return np.empty(0, np.int64), np.zeros(n + 1, np.int64)
    cut = np.zeros(len(data) + 1, dtype=bool)
    dark = (data > 0x20) & (data != 0x7F)
    alone = np.zeros(len(data), dtype=bool)
    alone[1:-1] = dark[:-2] & ~dark[1:-1] & dark[2:]
    cut[:-1] = alone & ((data == 0x20) | (data == 0x0A))
    cut[1:] |= alone & (data == 0x0A)
    cut[1:-1] |= _LETTER[data[:-1]] & _MARK[data[1:]]
    whole = data.tobytes()
    if any(x in whole for x in (*_WIDE_SPACE, *special)):
        for t in range(n):
            own = whole[offsets[t] : offsets[t + 1]]
            if any(x in own for x in (*_WIDE_SPACE, *special)):
                cut[offsets[t] : offsets[t + 1]] = False
    cut[offsets] = True
    starts = np.flatnonzero(cut[:-1])
    ends = np.append(starts[1:], len(data))
    keys, first, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    seen = seen or Pieces()
    begin, sizes = seen.find(keys, lambda k: encode([whole[a:b].decode() for a, b in zip(starts[first[k]].tolist(), ends[first[k]].tolist(), strict=True)]))
    own = sizes[back]
    place = np.concatenate([[0], np.cumsum(own)])
    ids = seen.ids[np.repeat(begin[back] - place[:-1], own) + np.arange(place[-1])].astype(np.int64)
    return ids, place[np.searchsorted(starts, offsets)]


def process_memo(name: str, make: Callable[[], object]) -> object:
    """An object that lives as long as this Python worker, across its tasks."""
    memo = sys.modules.setdefault("_emporia_memo", types.ModuleType("_emporia_memo"))
    if not hasattr(memo, name):
        setattr(memo, name, make())
    return getattr(memo, name)


def write_shards(docs: DataFrame, tokenizer_json: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into shards below ``folder``; return the index.

    One row a document: shard, part (the shard's place in the order), width (bytes
    an id), doc_id, at (place in the shard) and n_tokens, ``end_id`` included.  Rows
    are ordered by doc_id, then text; a null doc_id comes first and a null text is
    empty.  Every attempt of a task writes a shard of its own name, and only the
    index rows of the attempt that Spark commits point to one, so lost executors
    and speculative tasks do no harm.  Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or fresh_folder(spark, "shards")
    text = spark.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer, writer, seen, special, at = None, None, None, (), 0
        part = TaskContext.get().partitionId()
        path = f"{folder}/shard-{part:06d}-{uuid.uuid4().hex}.zst"

        def encode(pieces: list[str]) -> list[list[int]]:
            return [x.ids for k in range(0, len(pieces), 5_000) for x in tokenizer.encode_batch_fast(pieces[k : k + 5_000], add_special_tokens=False)]

        for batch in batches:
            if batch.num_rows == 0:
                continue
            if writer is None:
                name = f"{zlib.crc32(text.value.encode()):08x}"
                tokenizer = process_memo(f"tokenizer_{name}", lambda: Tokenizer.from_str(text.value))
                seen = process_memo(f"pieces_{name}", Pieces)
                special = tuple(x.content.encode() for x in tokenizer.get_added_tokens_decoder().values())
                width = 2 if max(tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else 4
                writer = ShardWriter(path, width)
            for t in slices(batch.column("text"), size=SLICE):
                ids, begin = encode_slice(encode, t.data, t.offsets, seen, special)
                n = len(begin) - 1
                # The end id goes behind each text.
                full = np.full(len(ids) + n, end_id, np.int64)
                full[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(begin))] = ids
                writer.write(full)
                count = np.diff(begin) + 1
                where = at + np.concatenate([[0], np.cumsum(count)[:-1]])
                at += len(full)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * n), pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, width, np.int32)), batch.column("doc_id")[t.first : t.first + n], pa.array(where), pa.array(count)],
                    names=["shard", "part", "width", "doc_id", "at", "n_tokens"],
                )
        if writer is not None:
            writer.close()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(run, INDEX_SCHEMA)
    index = f"{folder}/index"
    rows.write.parquet(index)
    return spark.read.schema(INDEX_SCHEMA).parquet(index)


def with_start(index: DataFrame) -> DataFrame:
    """``index`` with start: the ids of all documents before.  Sums are kept per
    shard, so the running sum is over one row a shard."""
    per = index.groupBy("part").agg(F.sum("n_tokens").alias("_ids"))
    before = F.coalesce(F.sum("_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return index.join(per.select("part", before.alias("_before")), "part").withColumn("start", F.col("_before") + F.col("at")).drop("_before")


def map_documents(index: DataFrame, schema: str, each: Callable[[np.ndarray], list]) -> DataFrame:
    """Read documents back: ``each`` of a document's ids gives the columns of
    ``schema`` (DDL), which follow those of ``index``.  Spans are read as listed, so
    rows in shard order decompress each frame once."""
    names = index.columns
    full = index.select("*").limit(0).selectExpr("*", *[f"cast(null as {x.strip().split(' ', 1)[1]}) as {x.strip().split(' ', 1)[0]}" for x in schema.split(",")]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, opened = None, None
        for batch in batches:
            got = []
            for shard, width, at, count in zip(*(batch.column(names.index(c)).to_pylist() for c in ("shard", "width", "at", "n_tokens")), strict=True):
                if opened != shard:
                    if reader:
                        reader.close()
                    reader, opened = ShardReader(shard, width), shard
                got.append(each(reader.read(at, count)))
            more = [pa.array([g[k] for g in got], pa.from_numpy_dtype(np.int64)) for k in range(len(full) - len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=full.names)
        if reader:
            reader.close()

    return index.mapInArrow(run, full)


def ids_crc32(ids: np.ndarray) -> list[int]:
    """crc32 of the ids as little-endian unsigned 32-bit integers."""
    return [zlib.crc32(ids.astype("<u4").tobytes())]


def token_digest(index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files that ``index`` names."""
    read = map_documents(index, "ids_crc32 long", ids_crc32)
    return with_start(read).select("doc_id", "start", "n_tokens", "ids_crc32")
