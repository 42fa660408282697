"""Scoring of whole texts by a unigram base and a recurrent language model.

Words are counted over all training texts.  The most frequent words (a fixed
number, so of bounded size) go to the workers; the others meet their counts in a
join.  The recurrent model knows ``TOKENS`` - 2 words and the end.  Any other word
is its unknown token times the word's share among all unknown tokens, smoothed as
in the base; as there, all words that training never saw are one type.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.bytecnn import fold
from emporia.llm.gru import END, GRU, TOKENS
from emporia.llm.scratch import stored
from emporia.llm.words import slices, word_hashes, words_of

FOLDS = 10
FREQUENT = 262_144
UNKNOWN = TOKENS - 2
END_HASH = 0x0E4D  # stands for the end in the table of counts


def counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(hashes, return_counts=True)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = []
        for t in slices(batch.column("text"), lower=True):
            parts.append(counted(word_hashes(t, words_of(t))))
        h, n = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        h, back = np.unique(h, return_inverse=True)
        n = np.bincount(back, n, len(h)).astype(np.int64)
        h, n = np.append(h, np.uint64(END_HASH)), np.append(n, batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])


def token_counts(docs: DataFrame) -> DataFrame:
    """(h, c): hash and count of every token of ``docs`` (text), ends included."""
    return docs.select("text").mapInArrow(_count_rows, "h long, n long").groupBy("h").agg(F.sum("n").alias("c"))


class Frequent(NamedTuple):
    """Sorted hashes of the frequent words with counts and token ids (UNKNOWN beyond
    the known ones), and the training count of every token id."""

    hashes: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    per_token: np.ndarray

    @staticmethod
    def of(hashes: np.ndarray, counts: np.ndarray, total: int, texts: int) -> Frequent:
        """From words by falling count."""
        ids = np.minimum(np.arange(len(hashes)), UNKNOWN)
        per = np.zeros(TOKENS)
        per[: min(len(counts), UNKNOWN)] = counts[:UNKNOWN]
        per[UNKNOWN], per[END] = total - texts - per.sum(), texts
        by = np.argsort(hashes)
        return Frequent(hashes[by], counts[by], ids[by], per)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash, and whether it is there."""
        if not len(self.hashes):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return at, self.hashes[at] == h

    def tokens(self, at: np.ndarray, there: np.ndarray) -> np.ndarray:
        return np.where(there, self.ids[at] if len(self.ids) else UNKNOWN, UNKNOWN)


def train(docs: DataFrame, frequent: Frequent, texts: int = 1500, longest: int = 20_000, rounds: int = 2) -> bytes:
    """The start of the model: fitted on the ``texts`` rows of ``docs`` (key, text) whose keys have the smallest hashes
    among those of up to ``longest`` characters, which bounds the sample, equal rows
    once; one task, weights back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lanes = []
        for batch in batches:
            for t in slices(batch.column("text"), lower=True):
                w = words_of(t)
                ids = frequent.tokens(*frequent.find(word_hashes(t, w)))
                lanes += [np.append(ids[a:b], END) for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
        model = GRU(frequent.per_token)
        if lanes:
            model.fit(lanes, rounds)
        yield pa.RecordBatch.from_arrays([pa.array([model.dump()], pa.binary())], names=["model"])

    # Keys are chosen first, so only the sample's few keys meet the texts.
    order = F.xxhash64("key", F.lit("lm"))
    short = docs.where(F.length("text") <= longest)
    keys = short.select("key").distinct().orderBy(order).limit(texts)
    sample = short.join(keys, "key").groupBy("key").agg(F.min("text").alias("text"))
    got = sample.repartition(1).sortWithinPartitions(order).mapInArrow(run, "model binary").first()
    return got["model"] if got else GRU(frequent.per_token).dump()


def train_on(docs: DataFrame, frequent, model: bytes) -> bytes:
    """``model`` trained on once over all rows of ``docs`` (text), long texts too, and
    ``frequent``, a broadcast of the fields of ``Frequent``.  Every task goes on from
    ``model`` with the rows it reads; the mean of their weights by tokens is taken, added
    up in two steps from rows of a fixed size, each of about as many as the square root
    of the tasks."""
    spread = math.isqrt(docs.rdd.getNumPartitions()) + 1
    schema = "some int, tokens long, weights binary"

    def row(some: int, tokens: int, weights: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([some], pa.int32()), pa.array([tokens], pa.int64()), pa.array([weights.tobytes()], pa.binary())], names=["some", "tokens", "weights"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, f = GRU.load(model), Frequent(*frequent.value)

        def parts() -> Iterator[list[np.ndarray]]:
            for batch in batches:
                lanes: list[np.ndarray] = []
                for t in slices(batch.column("text"), lower=True):
                    w = words_of(t)
                    ids = f.tokens(*f.find(word_hashes(t, w)))
                    lanes += [np.append(ids[a:b], END).astype(np.int16) for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True)]
                yield lanes

        tokens = net.go_on(parts())
        if tokens:
            yield row(TaskContext.get().partitionId() % spread, tokens, tokens * net.flat())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for some, tokens, weights in zip(*(batch.column(c) for c in ("some", "tokens", "weights")), strict=True):
                n, total = sums.get(some.as_py(), (0, 0))
                sums[some.as_py()] = (n + tokens.as_py(), total + np.frombuffer(weights.as_py()))
        for some, (n, total) in sums.items():
            yield row(some, n, total)

    some = docs.select("text").mapInArrow(run, schema).repartition("some").mapInArrow(add, schema)
    got = some.withColumn("some", F.lit(0)).repartition(1).mapInArrow(add, schema).first()
    net = GRU.load(model)
    if got:
        net.take(np.frombuffer(got["weights"]) / got["tokens"])
    return net.dump()


ROWS = "key long, doc_id long, held_out boolean, n_tokens long, n_unknown long, known long, base double, unknown_base double, score double, rare_h array<long>, rare_n array<int>"


def _score_rows(frequent, model: bytes):
    """``frequent`` is a broadcast of the fields of ``Frequent``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, f = GRU.load(model), Frequent(*frequent.value)
        end_log = np.log10(f.per_token[END] + 0.1)
        for batch in batches:
            n_rows = batch.num_rows
            lanes: list[np.ndarray] = []
            known, odd, base, odd_base = np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64), np.zeros(n_rows), np.zeros(n_rows)
            rare_h, rare_n, rare_to = [], [], [np.zeros(1, np.int64)]
            for t in slices(batch.column("text"), lower=True):
                w = words_of(t)
                h = word_hashes(t, w)
                n = len(w.bounds) - 1
                owner = np.repeat(np.arange(n), np.diff(w.bounds))
                at, there = f.find(h)
                ids = f.tokens(at, there)
                count = np.where(there, f.counts[at] if len(f.counts) else 0, 0)
                own, unknown = slice(t.first, t.first + n), ids == UNKNOWN
                logs = np.where(there, np.log10(count + 0.1), 0)
                base[own] = np.bincount(owner, logs, n)
                odd_base[own] = np.bincount(owner, np.where(unknown, logs, 0), n)
                known[own] = np.bincount(owner[there], minlength=n)
                odd[own] = np.bincount(owner[unknown], minlength=n)
                lanes += [np.append(ids[a:b], END).astype(np.int16) for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True)]
                missing = np.flatnonzero(~there)
                by = missing[np.lexsort((h[missing], owner[missing]))]
                new = np.ones(len(by), bool)
                new[1:] = (h[by][1:] != h[by][:-1]) | (owner[by][1:] != owner[by][:-1])
                first = np.flatnonzero(new)
                rare_h.append(h[by][first].view(np.int64))
                rare_n.append(np.diff(np.append(first, len(by))).astype(np.int32))
                rare_to.append(rare_to[-1][-1] + np.searchsorted(owner[by][first], np.arange(n), side="right"))
            score = net.score(lanes)
            n_tokens = np.array([len(x) for x in lanes], np.int64)
            to = pa.array(np.concatenate(rare_to).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(n_tokens),
                    pa.array(odd),
                    pa.array(known + (f.per_token[END] > 0)),
                    pa.array(base + end_log),
                    pa.array(odd_base),
                    pa.array(score / np.log(10)),
                    pa.ListArray.from_arrays(to, pa.array(np.concatenate([*rare_h, np.empty(0, np.int64)]))),
                    pa.ListArray.from_arrays(to, pa.array(np.concatenate([*rare_n, np.empty(0, np.int32)]))),
                ],
                names=[x.strip().split(" ")[0] for x in ROWS.split(",")],
            )

    return run


def score_texts(docs: DataFrame, sample_texts: int = 1500) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every
    row of ``docs`` (doc_id, text).

    Rows whose crc32(doc_id as text) mod 10 is 0 are held out of all learning.  A null
    text is empty and has one token, its end.  ``base_score`` adds log10((c + 0.1) /
    (N + 0.1 * (V + 1))) over the tokens; ``score`` is the recurrent model's log10
    probability of the whole text over the same V + 1 types.  A null doc_id counts as the empty text in the
    fold; repeated rows are counted and scored each.  Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", FOLDS) == 0).alias("held_out"), "text"
    )
    learned = rows.where("not held_out")
    counts = stored(token_counts(learned), "counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.sum(F.when(F.col("h") == END_HASH, F.col("c"))), F.lit(0)).alias("texts")).first()
    top = counts.where(F.col("h") != END_HASH).orderBy(F.desc("c"), "h").limit(FREQUENT).toArrow()
    frequent = Frequent.of(top.column("h").to_numpy().view(np.uint64), top.column("c").to_numpy(), total["n"], total["texts"])
    shared = spark.sparkContext.broadcast(tuple(frequent))
    model = train_on(learned, shared, train(learned.select("key", "text"), frequent, sample_texts))

    scored = stored(rows.mapInArrow(_score_rows(shared, model), ROWS), "scored")
    rare = scored.select("key", F.explode(F.arrays_zip("rare_h", "rare_n")).alias("w")).select("key", F.col("w.rare_h").alias("h"), F.col("w.rare_n").alias("n"))
    c = F.coalesce("c", F.lit(0))
    per = (
        rare.join(counts, "h", "left")
        .groupBy("key")
        .agg(F.sum(F.col("n") * F.log10(c + 0.1)).alias("rare_base"), F.sum(F.when(c > 0, F.col("n"))).alias("rare_known"))
    )
    # Rows that agree in doc_id and text have one key, which has the rare words of each.
    alike = scored.groupBy("key").agg(F.count("*").alias("alike"))
    per = alike.join(per, "key").select("key", (F.col("rare_base") / F.col("alike")).alias("rare_base"), (F.col("rare_known") / F.col("alike")).cast("long").alias("rare_known"))
    scale = float(np.log10(total["n"] + 0.1 * (total["v"] + 1)))
    unknown_types = max(0, total["v"] - (total["texts"] > 0) - min(len(frequent.hashes), UNKNOWN))
    unknown_scale = float(np.log10(frequent.per_token[UNKNOWN] + 0.1 * (unknown_types + 1)))
    more = F.coalesce("rare_base", F.lit(0.0))
    return scored.drop("rare_h", "rare_n").join(per, "key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * scale).alias("base_score"),
        (F.col("score") + F.col("unknown_base") + more - F.col("n_unknown") * unknown_scale).alias("score"),
    )
