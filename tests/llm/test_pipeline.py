"""The pipeline's stages take effect, each on all that its predecessor kept."""

from collections import Counter

import corpus_pipeline as pipeline
from emporia.llm import mixing
from emporia.llm.scratch import stored


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = [docs]
    for name, stage in pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], small), name))
    rows, quality, single, clean, mixed, shards = ([r for r in k.collect()] for k in kept)
    assert all(k.columns == docs.columns for k in kept[:-1])
    # Clean documents stay, most rejected ones are labelled 0.
    gone = {r.doc_id for r in rows} - {r.doc_id for r in quality}
    assert sum(labels.get(i) == 1 for i in gone) <= 0.05 * sum(v == 1 for v in labels.values())
    assert sum(labels.get(i) == 0 for i in gone) >= 0.7 * sum(v == 0 for v in labels.values())
    # One document of each group, by brute force.
    def shingle(t):
        w = t.encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}

    sets = {r.doc_id: shingle(r.text) for r in quality}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in single) == [i for i in ids if find(i) == i]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    text = {r.doc_id: " ".join(r.text.lower().split()) for r in single}
    leaked = {i for i, t in text.items() if any(x in t for x in items)}
    assert {r.doc_id for r in single} - {r.doc_id for r in clean} == leaked
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(kept[3]).collect()}
    assert Counter(r.doc_id for r in mixed) == Counter({i: n for i, n in copies.items() if n})
    assert Counter(r.doc_id for r in shards) == Counter(r.doc_id for r in mixed)


def test_run_writes_what_its_stages_keep(spark, small):
    """``run`` from documents to shards: the digest of every emitted text, in order of doc_id,
    and no planted leak or exact copy among them."""
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from emporia.llm.queries import tokenizer_json

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = sorted(pipeline.run(spark, small).collect(), key=lambda r: r.start)
    assert rows and [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    library, start = Tokenizer.from_str(tokenizer_json()), 0
    for r in rows:
        ids = [*library.encode(docs[r.doc_id], add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    copies = Counter(r.doc_id for r in rows)
    assert max(copies.values()) <= 3
    assert len({docs[i] for i in copies}) == len(copies)
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert not any(x in " ".join(docs[i].lower().split()) for i in copies for x in items)
