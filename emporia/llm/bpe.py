"""Byte-level BPE encoding and decoding by contiguous rank arrays.

A word is held as its parts' ids, one behind another, and the ranks of adjacent
parts.  Again and again the smallest rank is looked for (the leftmost of equal
ones), the boundary inside that pair is deleted, and the ranks beside the new part
are looked up anew, until no adjacent pair has a rank.  Many words are held as the
rows of one array: a row loses one part a round, so the rows with the same number of
parts, however long they once were, take each round together.  Scanning a long word
over and over would cost its length squared; beyond ``SHORT`` bytes a heap gives the
smallest rank instead, with the same result.

The tokenizer file gives merges, ids and added tokens; nothing is trained here.
"""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.llm.tokens import process_memo

SHORT = 64
MOST_WORDS, WORD_BYTES = 200_000, 20_000_000
SLICE = 2_000_000
NONE = np.int32(2**31 - 1)

# The byte-level pre-tokenizer's pattern.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Merges(NamedTuple):
    """A byte-level BPE as arrays: ``byte_id`` of every byte, sorted ``pairs`` (left id
    times ``size`` plus right id) with their ranks, ids by rank, bytes by id."""

    size: int
    byte_id: np.ndarray
    pairs: np.ndarray
    pair_rank: np.ndarray
    merged: np.ndarray
    token_bytes: list[bytes]
    added: dict[str, int]
    newer: str


def byte_chars() -> dict[str, int]:
    """The character that stands for each byte: printable Latin-1 for itself, the
    others, in order, from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + k): b for k, b in enumerate(rest)}}


@lru_cache(maxsize=1)
def newer_letters() -> str:
    """Ranges of letters and digits of the pattern library that the tokenizer's library,
    with older tables, takes for other characters."""
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    unsure = regex.compile(r"[\p{L}\p{N}]")
    ranges: list[list[int]] = []
    for k in range(sys.maxunicode + 1):
        c = chr(k)
        if unicodedata.category(c) == "Cn" and unsure.match(c) and len(split("a" + c)) == 2 and len(split("1" + c)) == 2:
            if ranges and ranges[-1][1] == k - 1:
                ranges[-1][1] = k
            else:
                ranges.append([k, k])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


def read_merges(tokenizer_json: str) -> Merges:
    """Read a byte-level BPE; ValueError for files with any other step."""
    j = json.loads(tokenizer_json)
    model, pre = j["model"], j.get("pre_tokenizer") or {}
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if model.get("type") != "BPE" or j.get("normalizer") or any(pre.get(k, True) != v for k, v in plain.items()):
        raise ValueError("not a plain byte-level BPE: model, normalizer or pre-tokenizer")
    if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        raise ValueError("not a plain byte-level BPE: model options")
    if (j.get("decoder") or {}).get("type") != "ByteLevel" or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in j["added_tokens"]):
        raise ValueError("not a plain byte-level BPE: decoder or added tokens")
    vocab, chars = model["vocab"], byte_chars()
    added = {t["content"]: t["id"] for t in j["added_tokens"]}
    size = max(max(vocab.values()), *added.values(), 0) + 1
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    pairs = np.array([vocab[a] * size + vocab[b] for a, b in merges], np.int64)
    order = np.argsort(pairs, kind="stable")
    token_bytes = [b""] * size
    for token, k in (*vocab.items(), *added.items()):
        token_bytes[k] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
    byte_id = np.zeros(256, np.int32)
    for c, b in chars.items():
        byte_id[b] = vocab[c]
    return Merges(size, byte_id, pairs[order], order.astype(np.int32), np.array([vocab[a + b] for a, b in merges], np.int32), token_bytes, added, newer_letters())


def pair_ranks(merges: Merges, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of each pair of adjacent parts, ``NONE`` if they never merge."""
    if not len(merges.pairs):
        return np.full(left.shape, NONE)
    key = left.astype(np.int64) * merges.size + right
    at = np.minimum(np.searchsorted(merges.pairs, key), len(merges.pairs) - 1)
    return np.where(merges.pairs[at] == key, merges.pair_rank[at], NONE)


def merge_short(merges: Merges, words: list[bytes]) -> list[bytes]:
    """Ids of each word, as little-endian unsigned 32-bit integers."""
    out: list[bytes] = [b""] * len(words)
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_length.setdefault(len(w), []).append(k)

    def finish(rows: np.ndarray, parts: np.ndarray) -> None:
        whole, step = parts.astype("<u4").tobytes(), 4 * parts.shape[1]
        for i, k in enumerate(rows.tolist()):
            out[k] = whole[i * step : (i + 1) * step]

    rows = np.empty(0, np.int64)
    parts = np.empty((0, max(by_length, default=0)), np.int32)
    ranks = np.empty((0, max(parts.shape[1] - 1, 0)), np.int32)
    for n in range(parts.shape[1], 0, -1):
        # The words of n bytes join those that have come down to n parts.
        if n in by_length:
            new = np.array(by_length[n])
            ids = merges.byte_id[np.frombuffer(b"".join([words[k] for k in by_length[n]]), np.uint8)].reshape(-1, n)
            rows, parts = np.concatenate([rows, new]), np.concatenate([parts, ids])
            ranks = np.concatenate([ranks, pair_ranks(merges, ids[:, :-1], ids[:, 1:])])
        if n == 1 or not len(rows):
            finish(rows, parts)
            rows, parts, ranks = rows[:0], parts[:0, : n - 1], ranks[:0, : max(n - 2, 0)]
            continue
        at = ranks.argmin(axis=1)
        best = ranks[np.arange(len(rows)), at]
        done = best == NONE
        finish(rows[done], parts[done])
        live = ~done
        rows, parts, ranks, at, best = rows[live], parts[live], ranks[live], at[live], best[live]
        # The boundary behind part ``at`` goes: what is right of it moves one place left.
        i, place = np.arange(len(rows)), np.arange(n - 1)
        parts = np.take_along_axis(parts, place + (place > at[:, None]), axis=1)
        parts[i, at] = merges.merged[best]
        place = place[: n - 2]
        ranks = np.take_along_axis(ranks, place + (place >= at[:, None]), axis=1)
        left, right = at > 0, at < n - 2
        ranks[i[left], at[left] - 1] = pair_ranks(merges, parts[i[left], at[left] - 1], parts[i[left], at[left]])
        ranks[i[right], at[right]] = pair_ranks(merges, parts[i[right], at[right]], parts[i[right], at[right] + 1])
    return out


def merge_long(merges: Merges, rank: dict[int, int], word: bytes) -> bytes:
    """As ``merge_short`` for one word of any length: linked parts, smallest ranks by heap."""
    parts = merges.byte_id[np.frombuffer(word, np.uint8)].tolist()
    n, size = len(parts), merges.size
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    merged = merges.merged
    first = pair_ranks(merges, np.array(parts[:-1], np.int32), np.array(parts[1:], np.int32))
    heap = [(r, i, parts[i], parts[i + 1]) for i, r in enumerate(first.tolist()) if r != NONE]
    heapq.heapify(heap)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = following[i]
        if parts[i] != a or j >= n or parts[j] != b:
            continue
        parts[i], parts[j] = int(merged[r]), -1
        following[i] = k = following[j]
        if k < n:
            before[k] = i
        for x, y in ((before[i], i), (i, k)):
            if x >= 0 and y < n:
                new = rank.get(parts[x] * size + parts[y])
                if new is not None:
                    heapq.heappush(heap, (new, x, parts[x], parts[y]))
    return np.array([p for p in parts if p >= 0], "<u4").tobytes()


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Encodes texts; the ids of words met before are kept, up to a bound."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.pattern = regex.compile(WORDS)
        self.newer = regex.compile(f"[{merges.newer}]") if merges.newer else None
        self.added = regex.compile("|".join(regex.escape(t) for t in sorted(merges.added, key=len, reverse=True))) if merges.added else None
        self.rank = dict(zip(merges.pairs.tolist(), merges.pair_rank.tolist(), strict=True))
        self.known: dict[str, bytes] = {}
        self.held = 0

    def split(self, text: str) -> list[str]:
        if self.newer and not is_latin(text) and self.newer.search(text):
            # Those characters count as marks: cut where a text with marks in their place is cut.
            return [text[m.start() : m.end()] for m in self.pattern.finditer(self.newer.sub("!", text))]
        return self.pattern.findall(text)

    def pieces(self, text: str) -> list[str | int]:
        """Words in order; an added token's id where the text spells it."""
        if self.added is None or not self.added.search(text):
            return self.split(text)
        out: list[str | int] = []
        at = 0
        for m in self.added.finditer(text):
            out += [*self.split(text[at : m.start()]), self.merges.added[m.group()]]
            at = m.end()
        return out + self.split(text[at:])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        split = [self.pieces(t) for t in texts]
        if len(self.known) > MOST_WORDS or self.held > WORD_BYTES:
            self.known, self.held = {}, 0
        new = [w for w in set().union(*split) if w not in self.known]
        # Added tokens and long words are not kept.
        extra: dict[str | int, bytes] = {w: w.to_bytes(4, "little") for w in new if isinstance(w, int)}
        words = [w for w in new if isinstance(w, str)]
        raw = [w.encode("utf-8", "replace") for w in words]
        short = [k for k, w in enumerate(raw) if len(w) <= SHORT]
        for k, ids in zip(short, merge_short(self.merges, [raw[k] for k in short]), strict=True):
            self.known[words[k]] = ids
            self.held += len(raw[k]) + len(ids)
        extra |= {words[k]: merge_long(self.merges, self.rank, w) for k, w in enumerate(raw) if len(w) > SHORT}
        self.known.update(extra)
        out = [b"".join(map(self.known.__getitem__, s)) for s in split]
        for w in extra:
            del self.known[w]
        return out


def decode_ids(token_bytes: list[bytes], ids: bytes) -> str:
    """The text of ids; bytes that are no UTF-8 become U+FFFD."""
    return b"".join([token_bytes[k] for k in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def _in_slices(values: list, sizes: list[int]) -> Iterator[tuple[int, int]]:
    at = held = 0
    for k in range(len(values)):
        if held and held + sizes[k] > SLICE:
            yield at, k
            at, held = k, 0
        held += sizes[k]
    if at < len(values):
        yield at, len(values)


def encode_texts(docs: DataFrame, tokenizer_json: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Every row of ``docs`` with ``ids``, the ids of its whole ``text`` as little-endian
    unsigned 32-bit integers (binary); a column of that name is replaced.

    A null text is empty, and an empty text has no ids.  Other columns, rows that are
    equal and rows without an id pass unchanged.  No row meets another, so nothing is
    shuffled; the merges go to each worker once.
    """
    merges = docs.sparkSession.sparkContext.broadcast(read_merges(tokenizer_json))
    rest = docs.drop(ids)
    schema = T.StructType([*rest.schema.fields, T.StructField(ids, T.BinaryType(), False)])
    name = f"bpe_{zlib.crc32(tokenizer_json.encode()):08x}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoder = process_memo(name, lambda: Encoder(merges.value))
            texts = [t or "" for t in batch.column(text).to_pylist()]
            for a, b in _in_slices(texts, [len(t) for t in texts]):
                got = pa.array(encoder.encode(texts[a:b]), pa.binary())
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), got], names=[*batch.schema.names, ids])

    return rest.mapInArrow(run, schema)


def decode_texts(rows: DataFrame, tokenizer_json: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Every row with ``text``, what its ``ids`` (as above) spell, added tokens included; null
    ids spell the empty text.  An id that the tokenizer lacks is an error."""
    merges = rows.sparkSession.sparkContext.broadcast(read_merges(tokenizer_json))
    rest = rows.drop(text)
    schema = T.StructType([*rest.schema.fields, T.StructField(text, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = merges.value.token_bytes
            values = [x or b"" for x in batch.column(ids).to_pylist()]
            for a, b in _in_slices(values, [len(x) for x in values]):
                got = pa.array([decode_ids(table, x) for x in values[a:b]], pa.string())
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), got], names=[*batch.schema.names, text])

    return rest.mapInArrow(run, schema)


def round_trip_digest(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ``docs`` (doc_id, text)."""
    ids = encode_texts(docs.select("doc_id", "text"), tokenizer_json).drop("text")
    both = decode_texts(ids, tokenizer_json)
    return both.select(
        "doc_id",
        F.expr("cast(octet_length(ids) / 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
