"""Every operator on nulls, empty and very long texts, repeated rows, empty tables and
columns whose names clash with its own."""

import pytest
from pyspark.sql import functions as F

from emporia.llm import bytecnn, jaccard, latent, licences, lines, lm, mixing, pivots, substrings, tokens
from emporia.llm.queries import tokenizer_json

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, rank string, tag string, key string, at string, h string, score string, copies string, part string, label string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
SAME = "The same fifteen words stand here twice and then once more for good measure okay"
TEXTS = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, SAME), (6, SAME), (6, SAME), (6, "another text\nunder the same id"), (None, SAME), (7, LONG), (8, "é è ü ß 漢字   x" * 5)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if i == 4 else f"s{(i or 0) % 2}", 0, 9, *["clash"] * 9) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (6, 0, 0), (6, 1, 0), (None, 1, 0), (7, None, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, SAME), (2, None), (3, ""), (None, SAME)], "item_id long, text string")


def by_id(df, *columns):
    return sorted((tuple(r[c] for c in ("doc_id", *columns)) for r in df.collect()), key=str)


def test_jaccard(docs, none):
    got = by_id(jaccard.jaccard_components(docs), "n_shingles", "component_id")
    words = len(SAME.split())
    assert got == sorted(
        [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, words - 4, 5), (6, words - 4, 5), (6, words - 4, 5), (6, 2, 5), (None, words - 4, None), (7, len({tuple(LONG.split()[i : i + 5]) for i in range(29_996)}), 7), (8, got_n(8), 8)],
        key=str,
    )
    assert jaccard.jaccard_components(none).count() == 0


def got_n(doc_id):
    import re

    w = [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", dict(TEXTS)[doc_id])]
    return len({tuple(w[i : i + 5]) for i in range(len(w) - 4)})


def test_lm(docs, none):
    got = lm.score_texts(docs, sample_texts=5)
    rows = by_id(got, "n_tokens", "score")
    assert len(rows) == len(TEXTS) and all(s < 0 for _, _, s in rows)
    assert {(i, n) for i, n, _ in rows} >= {(1, 1), (2, 1), (3, 1), (4, 2), (None, 16), (7, 30_001)}
    assert lm.score_texts(none).count() == 0


def test_latent(docs, none, benchmark):
    got = by_id(latent.find_leaks(docs, benchmark), "item_id")
    assert got == sorted([(5, 1), (6, 1), (6, 1), (None, 1)], key=str)
    assert latent.drop_leaks(docs, benchmark).columns == docs.columns
    assert sorted(by_id(latent.drop_leaks(docs, benchmark)), key=str) == sorted([(i,) for i, t in TEXTS if t != SAME], key=str)
    assert latent.find_leaks(none, benchmark).count() == 0
    assert latent.find_leaks(docs, benchmark.limit(0)).count() == 0


def test_mixing(docs, none):
    got = by_id(mixing.mix_sources(docs), "size", "copies")
    assert {n for i, n, _ in got if i in (1, 2, 3)} == {0}
    assert all(0 <= c <= 3 for _, _, c in got)
    emitted = mixing.emit_mix(docs)
    assert emitted.columns == docs.columns and emitted.count() == sum(c for _, _, c in got)
    assert {r.copies for r in emitted.collect()} == {"clash"}
    assert mixing.mix_sources(none).count() == 0


def test_quality(docs, none, labels):
    model = bytecnn.train(docs, labels, steps=3)
    got = by_id(bytecnn.score_quality(docs, model), "score")
    assert len(got) == len(TEXTS) and all(0 <= s <= 1 for _, s in got)
    assert {s for i, s in got if i in (1, 2)} == {s for i, s in got if i == 1}
    assert bytecnn.keep_quality(docs, model, 0.0).count() == len(TEXTS)
    assert bytecnn.keep_quality(docs, model, 1.1).count() == 0
    assert bytecnn.score_quality(none, bytecnn.train(none, labels.limit(0), steps=3)).count() == 0


def test_tokens(docs, none):
    got = tokens.token_digest(tokens.write_shards(docs, tokenizer_json())).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 4, 5, 6, 6, 6, 7, 8]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    assert [r.n_tokens for r in got if r.doc_id in (1, 2)] == [1, 1]
    assert tokens.token_digest(tokens.write_shards(none, tokenizer_json())).count() == 0


def test_lines(docs, none):
    got = by_id(lines.drop_line_copies(docs), "n_lines", "n_removed", "kept")
    assert (5, 1, 0, SAME) in got and got.count((6, 1, 1, "")) == 2 and (None, 1, 0, SAME) in got
    kept = {(i, n, r) for i, n, r, _ in got}
    assert kept >= {(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 1, 0), (5, 1, 0), (6, 1, 1), (6, 2, 0), (7, 1, 0)}
    assert lines.drop_line_copies(none).count() == 0


def test_substrings(docs, none):
    got = by_id(substrings.drop_repeats(docs), "n_words", "n_removed")
    words = len(SAME.split())
    assert got == sorted([(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 1, 0), (5, words, 0), (6, words, words), (6, words, words), (6, 6, 0), (None, words, 0), (7, 30_000, 0), (8, len(TEXTS[-1][1].encode().split()), 0)], key=str)
    assert substrings.drop_repeats(none).count() == 0


def test_licences(docs, none):
    assert all(r.n_rules == 0 and r.licences == [] for r in licences.scan_licences(docs).collect())
    assert licences.scan_licences(docs).count() == len(TEXTS)
    assert licences.scan_licences(none).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.01, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 0.0]), (6, [nan, 1.0, 0.0]), (7, [inf, 1.0, 0.0])]
    rows += [(8, []), (9, [1.0, 0.0, 0.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]), (11, [0.0, 1.0, 0.0]), (12, [0.0, 0.0, -1e300])]
    df = spark.createDataFrame([(*r, 5, "c") for r in rows], "vec_id long, embedding array<double>, label int, cls string")
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in pivots.near_duplicates(df).collect()}
    assert got >= {(1, 2, 1, True), (2, 2, 1, False), (9, 2, 1, False), (None, 0, None, True)}
    assert {(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 11, 12)} <= got
    assert pivots.near_duplicates(df).count() == len(rows)
    assert pivots.near_duplicates(df.limit(0)).count() == 0
    assert pivots.near_duplicates(df.where(F.col("vec_id") == 1)).count() == 1


def test_pipeline_stages(spark, docs, none, tmp_path):
    """Stages on the same rows and on none: columns stay, nothing crashes."""
    import corpus_pipeline

    for name, schema, rows in [
        ("labels", "doc_id long, quality int, toxic int", [(5, 1, 0), (7, 0, 0), (None, 1, 0)]),
        ("benchmark", "item_id long, text string", [(1, "an item that no document holds at all in any of its lines"), (2, None)]),
    ]:
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    by_name = dict(corpus_pipeline.STAGES)
    single = by_name["near_duplicates"](spark, docs, str(tmp_path))
    assert sorted((r.doc_id for r in single.collect()), key=str) == sorted([1, 2, 3, 4, 5, 7, 8, None], key=str)
    for table in (docs, none):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, table, str(tmp_path))
            assert name == "token_shards" or got.columns == docs.columns
            assert got.count() >= (0 if table is none else name != "quality")
