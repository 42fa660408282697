"""A byte-level convolutional network for text quality, in numpy.

Every byte has a learned vector; filters over ``WIDTH`` bytes run along the text at a
stride, their outputs are max-pooled in overlapping chunks that cover the whole text,
and the means and maxima over the chunks give one probability.

For scoring, byte vectors and filters fold into one table a filter place, so a filter
output is a sum of table rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.words import slices

WIDTH, STRIDE, CHUNK, STEP = 8, 4, 512, 384
BYTES, FILTERS = 6, 12
NAMES = ["embed", "filters", "bias", "weight", "offset"]


class Spans(NamedTuple):
    """Places of filters and chunks in padded bytes.  Chunk c pools filter outputs
    first[c] .. last[c] - 1; text t owns chunks owner == t."""

    data: np.ndarray
    places: np.ndarray
    first: np.ndarray
    last: np.ndarray
    owner: np.ndarray
    texts: int


def spans(data: np.ndarray, offsets: np.ndarray) -> Spans:
    """Every text is padded with zero bytes to at least one filter and one stride."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    outputs = np.maximum(1, -(-(sizes - WIDTH) // STRIDE) + 1)
    room = (outputs - 1) * STRIDE + WIDTH
    begin = np.concatenate([[0], np.cumsum(room)])
    padded = np.zeros(begin[-1], np.uint8)
    padded[np.repeat(begin[:-1] - offsets[:-1], sizes) + np.arange(offsets[0], offsets[-1])] = data
    out0 = np.concatenate([[0], np.cumsum(outputs)])
    places = np.repeat(begin[:-1] - out0[:-1] * STRIDE, outputs) + np.arange(out0[-1]) * STRIDE
    per, step = (CHUNK - WIDTH) // STRIDE + 1, STEP // STRIDE
    chunks = np.maximum(1, -(-(outputs - per) // step) + 1)
    owner = np.repeat(np.arange(n), chunks)
    rank = np.arange(int(chunks.sum())) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    first = out0[:-1][owner] + rank * step
    return Spans(padded, places, first, np.minimum(first + per, out0[1:][owner]), owner, n)


def pooled(outputs: np.ndarray, s: Spans) -> np.ndarray:
    """Maxima of each chunk; chunks overlap, so maxima of parts come first."""
    edges = np.unique(np.concatenate([s.first, s.last]))
    edges = edges[edges < len(outputs)]
    part = np.maximum.reduceat(outputs, edges, axis=0)
    a, b = np.searchsorted(edges, s.first), np.searchsorted(edges, s.last)
    best = part[a]
    for k in range(1, int((b - a).max(initial=1))):
        more = a + k < b
        best[more] = np.maximum(best[more], part[a[more] + k])
    return best


def summary(chunk: np.ndarray, s: Spans) -> np.ndarray:
    """Mean and maximum over a text's chunks."""
    at = np.flatnonzero(np.append(True, s.owner[1:] != s.owner[:-1]))
    count = np.diff(np.append(at, len(s.owner)))[:, None]
    return np.concatenate([np.add.reduceat(chunk, at, axis=0) / count, np.maximum.reduceat(chunk, at, axis=0)], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class ByteCNN:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {
            "embed": rng.normal(0, 0.5, (256, BYTES)),
            "filters": rng.normal(0, 1 / np.sqrt(WIDTH * BYTES), (WIDTH, BYTES, FILTERS)),
            "bias": np.zeros(FILTERS),
            "weight": np.zeros(2 * FILTERS),
            "offset": np.zeros(1),
        }

    def outputs(self, s: Spans) -> np.ndarray:
        tables = np.einsum("be,wef->wbf", self.p["embed"], self.p["filters"]).astype(np.float32)
        total = np.repeat(self.p["bias"].astype(np.float32)[None], len(s.places), axis=0)
        for w in range(WIDTH):
            total += np.take(tables[w], s.data[s.places + w], axis=0)
        return total

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        s = spans(data, offsets)
        chunk = np.maximum(pooled(self.outputs(s), s), 0)
        return sigmoid(summary(chunk, s) @ self.p["weight"] + self.p["offset"][0])

    def gradient(self, s: Spans, label: np.ndarray, share: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the weighted log loss; only the pooled places pass it on."""
        out = self.outputs(s)
        top = pooled(out, s)
        chunk = np.maximum(top, 0)
        feats = summary(chunk, s)
        d = (sigmoid(feats @ self.p["weight"] + self.p["offset"][0]) - label) * share
        dfeats = d[:, None] * self.p["weight"]
        at = np.flatnonzero(np.append(True, s.owner[1:] != s.owner[:-1]))
        count = np.diff(np.append(at, len(s.owner)))
        best = chunk == feats[:, FILTERS:][s.owner]
        dchunk = (dfeats[:, :FILTERS] / count[:, None])[s.owner] + dfeats[:, FILTERS:][s.owner] * best / np.maximum(np.add.reduceat(best, at, axis=0), 1)[s.owner]
        dchunk = dchunk * (top > 0)
        c, f = np.nonzero(dchunk)
        where = np.empty(len(c), np.int64)
        for k in range(FILTERS):
            mine = np.flatnonzero(f == k)
            where[mine] = [s.first[x] + int(np.argmax(out[s.first[x] : s.last[x], k])) for x in c[mine].tolist()]
        value = dchunk[c, f]
        g = {"weight": feats.T @ d, "offset": np.array([d.sum()]), "bias": np.bincount(f, value, FILTERS), "embed": np.zeros_like(self.p["embed"]), "filters": np.zeros_like(self.p["filters"])}
        for w in range(WIDTH):
            byte = s.data[s.places[where] + w]
            per = np.zeros((256, FILTERS))
            np.add.at(per, (byte, f), value)
            g["filters"][w] = self.p["embed"].T @ per
            g["embed"] += per @ self.p["filters"][w].T
        return g

    def fit(self, texts: list[bytes], label: np.ndarray, share: np.ndarray, steps: int, batch: int = 64, rate: float = 0.01, seed: int = 11) -> None:
        """``steps`` of Adam over shuffled batches, as many rounds as that takes."""
        rng = np.random.default_rng(seed)
        prior = np.clip((label * share).sum() / share.sum(), 0.01, 0.99)
        self.p["offset"][:] = np.log(prior / (1 - prior))
        m, v, t = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}, 0
        while t < steps:
            order = rng.permutation(len(texts))
            for at in range(0, min(len(order), batch * (steps - t)), batch):
                some = order[at : at + batch]
                offsets = np.cumsum([0, *(len(texts[i]) for i in some)])
                data = np.frombuffer(b"".join(texts[i] for i in some), np.uint8)
                g, t = self.gradient(spans(data, offsets), label[some], share[some] / len(some)), t + 1
                for k in NAMES:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    self.p[k] = self.p[k] - rate * (1 - t / (steps + 1)) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8) - 1e-5 * self.p[k]

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.p)
        return out.getvalue()

    @staticmethod
    def load(raw: bytes) -> ByteCNN:
        model = ByteCNN()
        with np.load(io.BytesIO(raw)) as got:
            model.p = {k: got[k] for k in NAMES}
        return model


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the doc_id as text, by ``folds``; null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def train(docs: DataFrame, labels: DataFrame, rows_per_label: int = 1500, longest: int = 50_000, steps: int = 560) -> bytes:
    """Fit on labelled rows whose fold is not 0; returns the model's weights.

    Of each label, ``rows_per_label`` ids with the smallest hashes are taken, less those
    whose text is longer than ``longest`` characters, which bounds the sample; an id
    with several labels or texts counts with the smallest.  Rows weigh so that labels
    keep their share.  Training runs in one task on that sample.
    Without rows of both labels the model gives the share of label 1, or one half
    without any.
    """
    marked = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_label"))
        .where("_id is not null and _label in (0, 1)")
        .where(fold("_id", 5) != 0)
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"))
    )
    totals = {r["_label"]: r["count"] for r in marked.groupBy("_label").count().collect()}
    # Ids are chosen from the labels alone, so only the sample's few ids meet the texts.
    parts = [marked.where(F.col("_label") == k).orderBy(F.xxhash64("_id", F.lit("train"))).limit(rows_per_label) for k in (0, 1)]
    texts = docs.select(F.col("doc_id").alias("_id"), "text").where(F.length("text") <= longest)
    chosen = texts.join(parts[0].union(parts[1]), "_id").groupBy("_id").agg(F.min("_label").alias("_label"), F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(b.column("_label").to_pylist(), b.column("text").to_pylist(), strict=True)]
        model = ByteCNN()
        if rows:
            label = np.array([r[0] for r in rows], float)
            seen = np.array([(label == 0).sum(), (label == 1).sum()])
            total = np.array([totals.get(0, 0), totals.get(1, 0)])
            share = (total / total.sum() / np.maximum(seen, 1) * len(rows))[label.astype(int)]
            model.fit([r[1].encode() for r in rows], label, share, steps)
        yield pa.RecordBatch.from_arrays([pa.array([model.dump()], pa.binary())], names=["model"])

    sample = chosen.select("_label", "text").repartition(1).sortWithinPartitions("_label", "text")
    got = sample.mapInArrow(run, "model binary").first()
    return got["model"] if got else ByteCNN().dump()


def _scores(model: bytes):
    """A function from a column of texts to scores, by slices."""
    net = ByteCNN.load(model)
    return lambda column: np.concatenate([np.empty(0), *(net.score(t.data, t.offsets) for t in slices(column, size=500_000))])


def score_quality(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, score) for every row of ``docs``: the probability of label 1 from the
    bytes of the whole text alone.  A null text is scored as an empty one; doc_id is
    handed through as it is, null or repeated; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scores(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score(batch.column("text")))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def keep_quality(docs: DataFrame, model: bytes, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``, with all columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scores(model)
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column("text")) >= least))

    return docs.mapInArrow(run, docs.schema)
