"""The registered text queries: against their SQL, or against brute force on the given tables."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from emporia.llm.queries import ORACLE_SQL, QUERIES, tokenizer_json
from emporia.sources.tables import TABLES, table_path
from oracle.check import digest
from oracle.types import duck_type

SMALL = "/root/testdata/sf0.001"


def rows_of(name):
    return pq.read_table(table_path(SMALL, name)).to_pylist()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMALL, t)}')")
    df = QUERIES[name](spark, SMALL)
    rel = con.sql(ORACLE_SQL[name])
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == {c: duck_type(t) for c, t in zip(rel.columns, rel.types)}
    rows, wanted = [tuple(r) for r in df.collect()], rel.fetchall()
    assert len(rows) == len(wanted) and digest(df.columns, rows)[0] == digest(rel.columns, wanted)[0]


def test_token_shards(spark):
    library, start = Tokenizer.from_str(tokenizer_json()), 0
    got = {r.doc_id: r for r in QUERIES["op6_token_shards"](spark, SMALL).collect()}
    for d in sorted(rows_of("documents"), key=lambda d: d["doc_id"]):
        ids = [*library.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        r = got.pop(d["doc_id"])
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


def test_vectors(spark):
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in rows_of("embeddings")]
    unit = np.array([v / np.linalg.norm(v) for _, v in rows])
    near = (unit @ unit.T >= 0.9) & ~np.eye(len(rows), dtype=bool)
    got = {r.vec_id: r for r in QUERIES["op9_pivot_neardup"](spark, SMALL).collect()}
    assert len(got) == len(rows)
    links = np.array([got[i].n_links for i, _ in rows])
    assert (links <= near.sum(axis=1)).all() and links.sum() >= 0.9 * near.sum()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_language_model_counts(spark):
    docs = rows_of("documents")
    words = {d["doc_id"]: [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")] + [None] for d in docs}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in words}
    counts = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    total, types = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in QUERIES["op2_gru_score"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    for i, ws in words.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(w in counts for w in ws), total)
        assert r.base_score == pytest.approx(sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in ws), rel=1e-9)
        assert np.isfinite(r.score) and r.score < 0
    # On texts it has not learned from, the model is better than the base.
    assert sum(got[i].score for i in words if held[i]) > sum(got[i].base_score for i in words if held[i])


def test_quality_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in rows_of("labels") if r["quality"] is not None}
    got = {r.doc_id: r for r in QUERIES["op5_byte_cnn"](spark, SMALL).collect()}
    assert len(got) == len({d["doc_id"] for d in rows_of("documents")})
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    good, bad = ([got[i].score for i, q in labels.items() if i in got and got[i].held_out and q == k] for k in (1, 0))
    if good and bad:
        assert np.mean([g > b for g in good for b in bad]) >= 0.8


def test_copies_of_benchmark_items(spark):
    """Every document that holds the words of an item is found."""
    flat = {d["doc_id"]: f" {' '.join(re.findall(r'[a-z0-9]+', (d['text'] or '').lower()))} " for d in rows_of("documents")}
    found = {r.doc_id for r in QUERIES["op3_latent_decontaminate"](spark, SMALL).collect()}
    for item in rows_of("benchmark"):
        words = " ".join(re.findall(r"[a-z0-9]+", (item["text"] or "").lower()))
        if len(words.split()) >= 8:
            assert {i for i, t in flat.items() if f" {words} " in t} <= found
