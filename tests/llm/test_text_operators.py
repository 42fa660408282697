"""Operators against brute force on small random tables."""

import math
import random
import textwrap
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from emporia.llm import bytecnn, components, gru, jaccard, latent, licences, lines, lm, mixing, pivots, sql, substrings, tokens, words
from emporia.llm.counttree import CountTree, Overlaps, counts, fold, needed, pack, spanning_links, unpack
from emporia.llm.queries import tokenizer_json


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


def near_copies(seed, groups=12, copies=6, size=60, change=0.03):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(3, size))]
        for _ in range(copies):
            out.append(" ".join(x if rng.random() > change else f"n{rng.randrange(9999)}" for x in base))
    out += out[:7] + ["", "a", "a b", "A  B"]
    rng.shuffle(out)
    return out


def shingles(text, n):
    w = [x.decode() for x in text.encode().lower().split()]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def linked_roots(pairs, n):
    root = list(range(n))
    for _ in range(n):
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
        if not changed:
            return root
    return root


@pytest.mark.parametrize("block", [4, 2048])
def test_jaccard_components(spark, block):
    texts = near_copies(3)
    sets = [shingles(t, 5) for t in texts]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = linked_roots(pairs, len(sets))
    got = jaccard.jaccard_components(frame(spark, texts), 5, 80, block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), want[i]) for i, s in enumerate(sets)}


def test_tree_finds_what_the_bound_allows():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in rng.integers(1, 200, 300)]
    sets += [np.unique(np.append(s[: max(1, int(len(s) * 0.95))], rng.integers(0, 2**63, 3).astype(np.uint64))) for s in sets[:100]]
    sets += [np.unique(rng.integers(0, 2**63, 9000).astype(np.uint64))]
    sets += [np.append(sets[-1][:8000], np.uint64(2**63 + 5))]
    full, sizes = [counts(s) for s in sets], np.array([len(s) for s in sets])
    assert all(np.array_equal(unpack(pack(p)), p) and p.sum() == n for p, n in zip(full, sizes))
    assert len(full[-1]) > 64 and unpack(pack(np.array([300]))).tolist() == [300]
    points = np.stack([fold(p, 64) for p in full])
    tree = CountTree(points, sizes, 80)
    for i in range(0, 402, 7):
        near = set(tree.find(points[i], int(sizes[i])).tolist())
        bound = np.minimum(points, points[i]).sum(axis=1)
        assert near >= {j for j in range(402) if len(np.intersect1d(sets[i], sets[j])) * 100 >= 80 * len(np.union1d(sets[i], sets[j]))}
        assert all(bound[j] >= needed(sizes[i], sizes[j], 80) for j in near)
    exact = Overlaps(sets, 80)
    links = spanning_links(full, sizes, 80, exact, hubs=1)
    assert all(exact.links(a, b) for a, b in links)
    all_links = [(a, b) for a in range(402) for b in range(a) if exact.links(a, b)]
    assert linked_roots(links, 402) == linked_roots(all_links, 402)


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = linked_roots(pairs, 461)
    assert got == {x: want[x] for p in pairs if p[0] != p[1] for x in p}


def test_word_hashes_match_a_plain_split():
    texts = ["Aa b\tc\x0bd\x1ee  f", None, "", "é x 漢", "x" * 5000 + " y", " lead and trail "]
    for t in words.slices(pa.array(texts, pa.string()), lower=True, size=20):
        w = words.words_of(t)
        raw = t.data.tobytes()
        for k, (a, b) in enumerate(zip(w.bounds[:-1], w.bounds[1:])):
            text = (texts[t.first + k] or "").encode().lower()
            assert [raw[i:j] for i, j in zip(w.starts[a:b], w.ends[a:b])] == text.split()


def test_gru_gradient_state_and_probability():
    rng = np.random.default_rng(0)
    model = gru.GRU(rng.integers(1, 50, gru.TOKENS))
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    texts = [rng.integers(0, gru.TOKENS, int(n)) for n in (5, 40, 33, 100)]
    w, h = next(gru.windows(texts, 4)), rng.normal(0, 0.1, (4, gru.HIDDEN))

    def loss():
        inside = w.targets >= 0
        return -model.log_probs(model.run(w, h)[0].astype(np.float64)[inside], w.targets[inside]).mean()

    g, _ = model.gradient(w, h)
    for k in gru.NAMES:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        old, e = model.p[k][at], 1e-3
        model.p[k][at] = old + e
        up = loss()
        model.p[k][at] = old - e
        down = loss()
        model.p[k][at] = old
        assert abs((up - down) / 2 / e - g[k][at]) < 1e-5
    # Windows, lanes and their order change nothing.
    alone = [model.score([t], 1)[0] for t in texts]
    assert np.allclose(model.score(texts, 2), alone, rtol=1e-5)
    total = np.exp(model.log_probs(np.repeat(rng.normal(0, 1, (1, gru.HIDDEN)), gru.TOKENS, 0), np.arange(gru.TOKENS))).sum()
    assert abs(total - 1) < 1e-4


def test_lm_base_and_gain(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice([f"a{k} b{k}", f"c{k} d{k}"]) for k in (rng.randrange(40) for _ in range(rng.randrange(1, 90)))) for _ in range(300)]
    got = {r.doc_id: r for r in lm.score_texts(frame(spark, texts)).collect()}
    held = {i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0}
    c = Counter(x for i, t in enumerate(texts) if i not in held for x in [*t.split(), "\n"])
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(texts):
        toks = [*t.split(), "\n"]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, len(toks), sum(c[x] > 0 for x in toks), n)
        assert abs(r.base_score - sum(np.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in toks)) < 1e-6
    assert sum(got[i].score for i in held) > sum(got[i].base_score for i in held)


def test_lm_rare_words_meet_their_counts(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 3)
    texts = ["x y z q", "x y r", "x x", "only", "x unseen"] * 3
    got = {r.doc_id: r for r in lm.score_texts(frame(spark, texts)).collect()}
    held = {i for i in range(15) if zlib.crc32(str(i).encode()) % 10 == 0}
    c = Counter(x for i, t in enumerate(texts) if i not in held for x in [*t.split(), "\n"])
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(texts):
        want = sum(np.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in [*t.split(), "\n"])
        assert abs(got[i].base_score - want) < 1e-9


def test_lm_learns_from_rows_beyond_the_sample(spark):
    rng = random.Random(31)
    row = lambda: " ".join(f"a{k} b{k} c{k}" for k in (rng.randrange(20) for _ in range(20)))
    got = lm.score_texts(frame(spark, [row() for _ in range(12_000)]), sample_texts=1).where("held_out").collect()
    assert sum(r.score for r in got) > 0.8 * sum(r.base_score for r in got)


def test_lm_sample_is_not_filled_by_a_repeated_row(spark):
    rows = [(0, "same")] * 200 + [(i, f"x{i}") for i in range(1, 30)]
    seen = []
    docs = spark.createDataFrame(rows, "key long, text string")
    for k in range(5):  # whichever key has the smallest hash
        many = docs.withColumn("key", docs.key + 1000 * k)
        first = many.select("key").distinct().orderBy(F.xxhash64("key", F.lit("lm"))).first()["key"]
        extra = spark.createDataFrame([(first, "x y z")] * 50, docs.schema)
        f = lm.Frequent.of(np.array([], np.uint64), np.array([], np.int64), 0, 0)
        seen.append(lm.train(many.union(extra), f, texts=20) != lm.train(extra, f, texts=20))
    assert all(seen)


def test_latent_finds_copies_and_paraphrases(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    rng = random.Random(4)
    items = {r.item_id: r.text.split() for r in bench.collect()}
    hosts = [r.text.split() for r in docs.where("length(text) > 1500").orderBy("doc_id").limit(len(items)).collect()]
    planted = []
    for k, (i, w) in enumerate(sorted(items.items())):
        changed = [x if rng.random() > 0.1 else rng.choice(hosts[0]) for x in w]
        host = hosts[k % len(hosts)]
        planted.append((10_000 + i, " ".join(host[: len(host) // 2] + changed + host[len(host) // 2 :])))
    got = {(r.doc_id, r.item_id) for r in latent.find_leaks(docs.union(spark.createDataFrame(planted, docs.schema)), bench).collect()}
    assert sum((10_000 + i, i) in got for i in items) >= 0.9 * len(items)
    norm = {r.doc_id: " ".join(r.text.lower().split()) for r in docs.collect()}
    verbatim = {(d, i) for d, t in norm.items() for i, w in items.items() if " ".join(w).lower() in t}
    assert verbatim <= got and {(d, i) for d, i in got if d < 10_000} == verbatim


def copies_of_an_item(rows, hot, words=40):
    """``rows`` texts of which the ``hot`` first hold item 1 and the next one item 2."""
    rng = random.Random(21)
    text = lambda n, tag: [f"{tag}{rng.randrange(5000)}" for _ in range(n)]
    items = {1: " ".join(text(30, "q")) + ".", 2: " ".join(text(30, "r")) + "."}
    texts = []
    for i in range(rows):
        w = text(words, "w")
        texts.append(" ".join([*w[: words // 2], *([items[1 if i < hot else 2]] if i <= hot else []), *w[words // 2 :]]))
    return texts, items, {(i, 1) for i in range(hot)} | {(hot, 2)}


@pytest.mark.parametrize("rows, hot", [(10, 2), (10, 9), (40, 3), (600, 200), (600, 100)])
def test_latent_finds_common_leaks_and_those_of_small_tables(spark, rows, hot):
    texts, items, want = copies_of_an_item(rows, hot)
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    docs = frame(spark, texts)
    assert {(r.doc_id, r.item_id) for r in latent.find_leaks(docs, bench).collect()} == want
    assert {r.doc_id for r in latent.drop_leaks(docs, bench).collect()} == set(range(hot + 1, rows))


@pytest.mark.parametrize("size", [20, 64, 90])
def test_spans_in_order(size):
    rng = np.random.default_rng(size)
    item, hashes = rng.integers(0, 30, size).astype(np.uint64), rng.integers(0, 60, 900).astype(np.uint64)
    low = np.arange(0, 900 - 3 * size, 7)
    got = latent.spans_in_order(hashes, low, low + 3 * size, item, size / 2)
    common = [latent.common_subsequence(item, hashes[a : a + 3 * size]) for a in low.tolist()]
    want = [k for k, n in enumerate(common) if n >= size / 2]
    assert set(want) <= set(got.tolist()) and (size > 64 or got.tolist() == want)


def test_common_subsequence():
    rng = random.Random(6)
    for _ in range(50):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(0, 25))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert latent.common_subsequence(np.array(a, np.int64), np.array(b, np.int64)) == t[-1][-1]


def test_svd_matches_numpy():
    rng = np.random.default_rng(2)
    a = np.zeros((200, latent.DIMS))
    a[:, :50] = rng.normal(size=(200, 50)) * np.linspace(5, 0.1, 50)
    w = latent.random_directions()
    got = latent.solve(np.ones(latent.DIMS), a.T @ (a @ w), w)
    assert np.allclose(got.singular[:40], np.linalg.svd(a, compute_uv=False)[:40], rtol=1e-3)


def test_svd_is_of_every_text(spark):
    """50 words, each alone in 500 of 25,000 texts: singular values follow from the counts."""
    docs = spark.range(25_000, numPartitions=4).select(F.concat(F.lit("w"), F.col("id") % 50).alias("text"))
    got = latent.fit(docs)
    dims = latent.dims_of(words.word_hashes(*first_words([f"w{i}" for i in range(50)])))
    per_dim = np.bincount(dims, minlength=latent.DIMS) * 500
    idf = np.where(per_dim, np.log(25_001 / (per_dim + 1)) + 1e-3, 0)
    want = np.sort(np.sqrt(per_dim) * idf)[::-1]
    assert np.allclose(got.singular[:50], want[:50], rtol=1e-4)


def test_svd_has_no_switch_by_size(spark):
    """The same texts twice over only scale the model."""
    docs = spark.range(12_000, numPartitions=4).select(F.concat(F.lit("w"), F.col("id") % 60).alias("text"))
    once, twice = latent.fit(docs), latent.fit(docs.union(docs))
    assert np.allclose(twice.singular[:50], math.sqrt(2) * once.singular[:50], rtol=2e-3)


@pytest.mark.parametrize("copies", [1, 40, 2000])
def test_leaks_do_not_depend_on_the_number_of_rows(spark, copies):
    """Twelve texts have fewer passages than the model has directions, however often they are repeated."""
    rng = random.Random(31)
    word = lambda n: " ".join(f"w{rng.randrange(20_000)}" for _ in range(n))
    items = [word(n) for n in (18, 30, 45, 59, 100)]
    texts = [" ".join([word(150), *items[k : k + 1], word(200)]) for k in range(12)]
    docs = frame(spark, texts).crossJoin(spark.range(copies).select(F.col("id").alias("copy")))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = latent.drop_leaks(docs, bench).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == dict.fromkeys(range(5, 12), copies)


def first_words(texts):
    t = next(words.slices(pa.array(texts), lower=True, size=10**6))
    return t, words.words_of(t)


def test_sketch_matches_numpy():
    """Texts of several passages, repeated words, words without weight and texts without words."""
    rng = random.Random(8)
    texts = [" ".join(f"w{int(rng.paretovariate(0.4)) % 900}" for _ in range(rng.choice([0, 1, 63, 64, 65, 200]))) for _ in range(700)]
    t, _ = first_words(texts)
    table = np.zeros((latent.DIMS, 2))
    latent.frequencies(t, table)
    parts = [text.split()[k : k + 64] for text in texts for k in range(0, len(text.split()), 64)]
    a = np.zeros((len(parts), latent.DIMS))
    for i, part in enumerate(parts):
        np.add.at(a[i], latent.dims_of(words.word_hashes(*first_words([" ".join(part)]))), 1)
    assert (table[:, 0] == len(parts)).all() and (table[:, 1] == (a > 0).sum(axis=0)).all()
    idf, w = latent.idf_of(table, 0.03), latent.random_directions()
    assert (idf == 0).any()
    got = np.zeros((latent.DIMS, w.shape[1]))
    latent.sketch(t, np.vstack([w * idf[:, None], np.zeros(w.shape[1])]).astype(np.float32), got)
    want = a.T @ (a @ (idf[:, None] * w))
    want[idf == 0] = 0
    assert np.allclose(got, want, rtol=1e-4, atol=1e-3 * np.abs(want).max())


def windows_case():
    """Random word vectors, items for every width, and texts of many sizes that hold parts of them."""
    rng = random.Random(12)
    idf = np.random.default_rng(12).uniform(0.1, 3, latent.DIMS)
    idf[::5] = 0
    vectors = np.random.default_rng(13).normal(size=(latent.DIMS, latent.RANK)) * idf[:, None]
    model = latent.Latent(idf, np.vstack([vectors, np.zeros(latent.RANK)]).astype(np.float32), np.ones(latent.RANK))
    word = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    asked = [word(n) for n in (7, 14, 30, 40, 70, 130, 140)]
    texts = []
    for k in range(400):
        host = word(rng.choice([0, 1, 15, 16, 17, 31, 63, 64, 65, 127, 128, 129, 200, 330]))
        at = rng.randrange(len(host) + 1)
        texts.append(" ".join([*host[:at], *rng.choice(asked)[: rng.choice([0, 5, 20, 200])], *host[at:]]))
    return texts, model, latent.prepare_items([(i, " ".join(w)) for i, w in enumerate(asked)], model)


@pytest.mark.parametrize("only", [None, 16, 32, 64, 128])
def test_windows_match_brute_force(only):
    texts, model, items = windows_case()
    if only:
        keep = np.flatnonzero(items.window == only)
        pick = lambda v: v[keep] if isinstance(v, np.ndarray) else [v[k] for k in keep]
        items = latent.Items(*map(pick, items))
    t, w = first_words(texts)
    hashes, bounds, search = words.word_hashes(t, w), w.bounds.tolist(), latent.Search()
    assert len(hashes) > 2 * latent.CHUNK * latent.STEP and not items.exact.any()
    want = {}
    for text, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        for j, width in enumerate(items.window.tolist()):
            for first in range(a, max(b - width, a) + width // 4 if b > a else a, width // 4):
                dims = latent.dims_of(hashes[first : min(first + width, b)])
                v = model.words[dims].astype(float).sum(axis=0)
                cosine = v @ items.vectors[j] / np.linalg.norm(v) if v.any() else 0.0
                shared = np.bitwise_count(np.bitwise_or.reduce(latent.signatures(dims, model.idf)) & items.bits[j]).sum()
                if shared >= search.bits * np.bitwise_count(items.bits[j]).sum():
                    want[text, j, first, min(first + width, b)] = cosine
    got = {tuple(x[:4]): x[4] for x in latent.candidates(hashes, w.bounds, model, items, search)}
    assert len(got) > 20 and all(abs(want[k] - x) < 1e-4 for k, x in got.items())
    assert {k for k, x in want.items() if x >= search.cosine + 1e-4} <= set(got)


def test_windows_are_summed_a_part_at_a_time():
    """Short texts take no room for the widest window each, and sums don't grow with the slice."""
    _, model, items = windows_case()
    rng = random.Random(14)
    t, w = first_words([" ".join(f"w{rng.randrange(4000)}" for _ in range(rng.choice([40, 300]))) for _ in range(500)])
    hashes = words.word_hashes(t, w)
    tracemalloc.start()
    for _ in latent.candidates(hashes, w.bounds, model, items, latent.Search()):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < len(hashes) // latent.STEP * latent.RANK * 4  # one vector for each block of words


def waterfill(sizes, weights, most):
    target, free = {}, set(sizes)
    total = sum(sizes.values())
    while True:
        left = total - sum(target.values())
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = most * sizes[s]
        free -= over


def test_mixing_targets(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 80)), rng.choice([None, "b", "a", "huge", "huge", "huge", "c", "é"])) for i in range(900)]
    rows.append((5000, "one word", "tiny"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(df).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    want = waterfill(sizes, {s: k % 3 + 1 for k, s in enumerate(order)}, 3)
    taken = Counter()
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 * want[r.source] and r.copies in (int(r.rate), int(r.rate) + 1) and r.copies <= 3
        taken[r.source] += r.copies * r.size
    # One draw a document, so about a hundred documents a source scatter by a tenth.
    assert all(abs(taken[s] - want[s]) < 0.35 * want[s] + 2 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(df.repartition(7)).collect()))


def test_cnn_pooling_and_learning():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (0, 3, 8, 9, 511, 512, 513, 3000)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    s = bytecnn.spans(data, offsets)
    net = bytecnn.ByteCNN()
    out = net.outputs(s)
    assert np.array_equal(bytecnn.pooled(out, s), np.array([out[a:b].max(axis=0) for a, b in zip(s.first, s.last)]))
    # Every byte lies under a filter, and every filter place in a chunk.
    assert all(set(np.flatnonzero(s.owner == t)) for t in range(len(texts)))
    covered = np.zeros(len(out), bool)
    for a, b in zip(s.first, s.last):
        covered[a:b] = True
    assert covered.all()
    one = [net.score(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(net.score(data, offsets), one)
    clean = [b"plain words in a row with nothing odd about them " * int(n) for n in rng.integers(1, 30, 150)]
    junk = [b"wo### rds$$$ in&&& a*** row%%% " * int(n) for n in rng.integers(1, 30, 150)]
    label = np.array([1.0] * 150 + [0.0] * 150)
    net.fit(clean + junk, label, np.ones(300), 60)
    both = clean + junk
    got = net.score(np.frombuffer(b"".join(both), np.uint8), np.cumsum([0, *map(len, both)]))
    assert ((got > 0.5) == (label == 1)).mean() > 0.97
    assert np.allclose(bytecnn.ByteCNN.load(net.dump()).score(data, offsets), net.score(data, offsets))


def test_cnn_gradient():
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (30, 700, 1500)]
    s = bytecnn.spans(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    net = bytecnn.ByteCNN()
    net.p["weight"] = rng.normal(size=2 * bytecnn.FILTERS)
    label, share = np.array([1.0, 0.0, 1.0]), np.array([0.2, 0.3, 0.5])

    def loss():
        f = bytecnn.summary(np.maximum(bytecnn.pooled(net.outputs(s), s), 0), s)
        z = f @ net.p["weight"] + net.p["offset"][0]
        return (share * (np.log1p(np.exp(z)) - label * z)).sum()

    g = net.gradient(s, label, share)
    for k in bytecnn.NAMES:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        old, e = net.p[k][at], 1e-3
        net.p[k][at] = old + e
        up = loss()
        net.p[k][at] = old - e
        down = loss()
        net.p[k][at] = old
        assert abs((up - down) / 2 / e - g[k][at]) < 0.03 * abs(g[k][at]) + 1e-4


def test_quality_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    model = bytecnn.train(docs, labels)
    rows = bytecnn.score_quality(docs, model).join(labels, "doc_id").where(bytecnn.fold("doc_id", 5) == 0).collect()
    assert np.mean([(r.score >= 0.3) == (r.quality == 1) for r in rows]) > 0.9


def test_token_shards_round_trip(spark, tmp_path):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["the", "naïve", "3.14", "don't", "x,y", "<|endoftext|>", "a b", "\n\n", "tab\tbed", "###", "漢字"]) for _ in range(rng.randrange(0, 60))) for _ in range(200)]
    texts[17] = " ".join(f"word{i % 5000}" for i in range(80_000))
    folder = f"file://{tmp_path}/shards"
    index = tokens.write_shards(frame(spark, texts), tokenizer_json(), 0, folder)
    from tokenizers import Tokenizer

    plain = Tokenizer.from_str(tokenizer_json())
    start = 0
    for r, t in zip(tokens.token_digest(index).orderBy("doc_id").collect(), texts, strict=True):
        ids = [*plain.encode(t, add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    row = index.where("doc_id = 17").first()
    reader = tokens.ShardReader(row.shard, row.width)
    assert reader.read(row.at + 70_000, 10).tolist() == [*plain.encode(texts[17], add_special_tokens=False).ids, 0][70_000:70_010]
    # One frame was read; a changed byte in another is found by its checksum only there.
    assert reader.last[0] == (row.at + 70_000) // tokens.FRAME
    path = row.shard.removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    raw[40] ^= 0xFF
    (tmp_path / "bad.zst").write_bytes(raw)
    bad = tokens.ShardReader(str(tmp_path / "bad.zst"), row.width)
    with pytest.raises(Exception):
        bad.read(0, 5)
    assert len(bad.read(tokens.FRAME, 5)) == 5


def test_line_runs(spark):
    rng = random.Random(10)
    pool = [f"line {i}" for i in range(25)] + ["x" * 150, "one more\tline", " three short words ", ""]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 30))) for _ in range(60)]
    texts += [texts[3], texts[4] + "\n" + texts[5], "a\nb\na\nb\na\nb", "only", "\nonly \n"]
    got = {r.doc_id: r for r in lines.drop_line_copies(frame(spark, texts)).collect()}
    seqs = [[x.strip() for x in t.split("\n") if x.strip()] for t in texts]
    first, longest, gone = {}, Counter(), [set() for _ in seqs]
    for k in range(6):
        n = 2**k
        seen = {}
        for d, s in enumerate(seqs):
            for i in range(len(s) - n + 1):
                run = tuple(s[i : i + n])
                if run in seen:
                    longest[d] = max(longest[d], n)
                    if n == 2 or n == 1 and (len(run[0].split()) >= 3 or len(s) == 1):
                        gone[d].update(range(i, i + n))
                seen.setdefault(run, (d, i))
    for d, s in enumerate(seqs):
        kept = [x for i, x in enumerate(s) if i not in gone[d]]
        r = got[d]
        assert (r.n_lines, r.n_removed, r.longest_shared) == (len(s), len(gone[d]), longest[d])
        assert [x.strip() for x in r.kept.split("\n") if x.strip()] == kept


def test_suffix_ranks_are_the_suffix_array(spark):
    rng = random.Random(11)
    texts = ["\n".join(rng.choice("abc") for _ in range(rng.randrange(1, 14))) for _ in range(25)]
    rows = lines.line_ids(lines.tagged(frame(spark, texts))).cache()
    h = {(r.doc_id, r.at): r.h for r in rows.collect()}
    found = lines.suffix_intervals(rows).collect()
    for n in {r.length for r in found}:
        level = [(r.rank, tuple(h.get((r.doc_id, r.at + k)) for k in range(n))) for r in found if r.length == n]
        assert all((a[0] < b[0]) == (a[1] < b[1]) for a in level for b in level if a[0] != b[0])
        assert len({x for x, _ in level}) == len({x for _, x in level})


def test_substrings_and_doubling(spark):
    rng = random.Random(12)
    passage = [f"p{i}" for i in range(70)]
    texts = []
    for i in range(80):
        w = [f"v{rng.randrange(60)}" for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            a = rng.randrange(0, 40)
            at = rng.randrange(0, len(w) + 1)
            w[at:at] = passage[a : a + rng.randrange(5, 60)]
        texts.append("  ".join(w))
    df = frame(spark, texts)
    got = {r.doc_id: r for r in substrings.drop_repeats(df, 13).collect()}
    first, gone = {}, [set() for _ in texts]
    for d, t in enumerate(texts):
        w = t.split()
        for i in range(len(w) - 12):
            if first.setdefault(tuple(w[i : i + 13]), d) < d:
                gone[d].update(range(i, i + 13))
    for d, t in enumerate(texts):
        w = t.split()
        assert (got[d].n_words, got[d].n_removed, got[d].kept) == (len(w), len(gone[d]), " ".join(x for i, x in enumerate(w) if i not in gone[d]))
    levels = {r.length for r in substrings.longer_repeats(substrings.repeated_windows(substrings.tagged(df), 13)).collect()}
    assert 26 in levels and all(n in (13, 26, 52) for n in levels)


def test_pivot_recall_and_counts(spark):
    rng = np.random.default_rng(13)
    base = rng.normal(size=(150, 32))
    rows = [b + rng.normal(size=32) * 0.22 * rng.random() for b in base for _ in range(4)] + [base[0]] * 5
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    for block in (8, 4096):
        got = {r.vec_id: r for r in pivots.near_duplicates(df, 0.9, block=block).collect()}
        links = np.array([got[i].n_links for i in range(len(rows))])
        assert (links <= near.sum(axis=1) - 1).all() and links.sum() >= 0.9 * (near.sum() - len(rows))
        assert all(got[i].kept == (got[i].component_id == i) for i in got)
        assert len({got[i].component_id for i in range(600, 605)}) == 1


def pairs_at(rng, count, dims, cosine):
    a, turn = (rng.normal(size=(count, dims)) for _ in range(2))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    turn -= (turn * a).sum(axis=1, keepdims=True) * a
    return a, cosine * a + np.sqrt(1 - cosine**2) * turn / np.linalg.norm(turn, axis=1, keepdims=True)


def test_pivot_recall_at_the_threshold_with_many_pivots(spark):
    rng = np.random.default_rng(14)
    a, b = pairs_at(rng, 600, 64, 0.902)
    rows = np.vstack([a, b, rng.normal(size=(12_000, 64))])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows.tolist())], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.component_id for r in pivots.near_duplicates(df, 0.9, list_rows=0.05).collect()}
    assert sum(got[i + 600] == i for i in range(600)) >= 0.95 * 600


def test_pivots_near_enough_for_large_tables():
    rng = np.random.default_rng(15)
    (chosen, _), (probes, _) = (pairs_at(rng, n, 64, 1) for n in (7415, 1000))
    near = pivots.enough_near(chosen, probes, 0.9, 6)
    for cosine in (0.9, 0.92):
        a, b = (pivots.near_pivots(v, chosen, near) for v in pairs_at(rng, 1000, 64, cosine))
        assert np.mean((a[:, :, None] == b[:, None, :]).any(axis=2).sum(axis=1) >= 2) >= 0.93
    assert pivots.enough_near(chosen[:153], probes, 0.9, 6) == 6


def test_one_longer_vector_does_not_set_the_width(spark):
    rows = [(i, [1.0, 2.0 + i / 1000]) for i in range(5)] + [(9, [1.0, 2.0, 3.0])]
    got = {r.vec_id: r.n_links for r in pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {**dict.fromkeys(range(5), 4), 9: 0}


def test_licence_rules(spark):
    grant, notice, warranty = (licences.SENTENCES[k] for k in ("mit-grant", "mit-notice", "mit-warranty"))
    texts = [
        "Some words. Released under the MIT License.\nMore.",
        f"{grant.upper()}. Other things stand here!\n({notice})\n{warranty}; and more",
        f"{notice}. {grant}. {warranty}.",
        "Licensed under the Apache License, Version 2.0. This work is licensed under the GNU General Public License, version 3.",
        "Not released under the MIT License",
    ]
    got = {r.doc_id: (r.licences, r.sentence_ids) for r in licences.scan_licences(frame(spark, texts)).collect()}
    assert got[0] == (["MIT"], ["mit-released"]) and got[1] == (["MIT"], ["mit-grant", "mit-notice", "mit-warranty"])
    assert got[2][0] == [] and got[3][0] == ["Apache-2.0", "GPL-3.0"] and got[4] == ([], [])


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY ARE DISCLAIMED."""


@pytest.mark.parametrize("end, lead", [(None, ""), ("\n", ""), ("\r\n", ""), ("\n", " * ")])
def test_licence_headers_as_published(spark, end, lead):
    def wrapped(text):
        if end is None:
            return text
        return end.join(lead + line for part in text.split("\n") for line in textwrap.wrap(part, 70) or [""])

    texts = [
        *map(wrapped, (MIT, APACHE, GPL, BSD, BSD.replace("COPYRIGHT HOLDERS", "REGENTS"), GPL.replace("software:", "software;").replace("version 3", "version 2"))),
        wrapped("The code was first _released under the MIT license_ by its authors"),
        "It is unreleased under the MIT licenses",
        "The code isn't released under the MIT license, and has never been released under the MIT license",
        "Licensed under the Apache License,\n\nVersion 2.0",
        "Licensed under CC. BY-NC 4.0",
    ]
    got = {r.doc_id: r for r in licences.scan_licences(frame(spark, texts)).collect()}
    assert [got[i].licences for i in range(len(texts))] == [["MIT"], ["Apache-2.0"], ["GPL"], ["BSD"], ["BSD"], ["GPL"], ["MIT"], [], [], [], []]
    assert got[1].sentence_ids == ["apache-short", "apache-may-not", "apache-copy", "apache-basis"] and got[1].n_rules == 2
    # The SQL says the same of these texts.
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [*enumerate(texts), (99, None), (100, "")])
    said = {i: (ids, held, n) for i, ids, held, n in con.execute(sql.LICENCE_SQL).fetchall()}
    assert said.pop(99) == said.pop(100) == ("", "", 0)
    assert said == {i: ("|".join(r.sentence_ids), "|".join(r.licences), r.n_rules) for i, r in got.items()}


HEADERS = {
    "BSD-3-Clause": BSD.replace("THIS SOFTWARE", "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "LGPL": GPL.replace("program", "library").replace("GNU General", "GNU Lesser General"),
    "AGPL": GPL.replace("GNU General", "GNU Affero General"),
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES.",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
}


def test_each_header_has_its_licence_alone(spark):
    names = list(HEADERS)
    got = {r.doc_id: r.licences for r in licences.scan_licences(frame(spark, ["\n".join(textwrap.wrap(p, 60)) if "\n" not in p else p for p in HEADERS.values()])).collect()}
    assert [got[i] for i in range(len(names))] == [[n] for n in names]


def test_model_and_shares_sum_to_one():
    """Over the known words, the end, and all other words by their smoothed counts and the
    one type never seen, the probabilities after any state sum to 1."""
    rng = np.random.default_rng(3)
    model = gru.GRU(rng.integers(1, 50, gru.TOKENS).astype(float))
    model.p = {k: v + rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in model.p.items()}
    states = rng.normal(0, 1, (5, gru.HIDDEN)).astype(np.float32)
    every = np.arange(gru.TOKENS)
    logs = np.array([model.log_probs(np.repeat(s[None], gru.TOKENS, axis=0), every) for s in states], np.float64)
    known = np.delete(np.exp(logs), lm.UNKNOWN, axis=1).sum(axis=1)
    # As score_texts puts it together: the unknown token times a word's smoothed share.
    counts = np.array([7, 3, 1, 1])
    total, types = counts.sum(), len(counts)
    shares = np.append((counts + 0.1), 0.1) / (total + 0.1 * (types + 1))
    unknown = np.exp(logs[:, lm.UNKNOWN])[:, None] * shares
    assert np.allclose(known + unknown.sum(axis=1), 1, atol=1e-4)


def test_softmax_of_large_scores():
    x = np.array([[0.0, 1.0, 200.0], [-300.0, -301.0, -299.0]], np.float32)
    want = x - x.max(axis=1, keepdims=True)
    want -= np.log(np.exp(want.astype(np.float64)).sum(axis=1, keepdims=True))
    assert np.allclose(gru.log_softmax(x), want, atol=1e-5)


def brute_links(vectors, least=0.9):
    out = Counter()
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors):
            if i != j and len(a) == len(b) and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= least:
                out[i] += 1
    return out


def test_vectors_of_other_lengths_link_with_their_like(spark):
    rng = np.random.default_rng(16)
    rows = [[1.0, 2.0, 3.0], [1.0, 2.0, 3.05], [3.0, -1.0, 0.0], [1.0], [2.0], [-1.0], [1.0, 1.0], [1.0, 1.01], [-1.0, -1.0]]
    rows += [(b + rng.normal(size=6) * 0.1).tolist() for b in rng.normal(size=(12, 6)) for _ in range(3)]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    want = brute_links(rows)
    # With blocks of two, the six-component vectors and others have indexes of their own.
    for block in (2, 4096):
        got = {r.vec_id: r.n_links for r in pivots.near_duplicates(df, block=block).collect()}
        assert {i: got[i] for i in range(9)} == {i: want[i] for i in range(9)}


def test_equal_scores_link_alike_in_any_partition(spark):
    """Components of -1, 0 and 1 tie with many pivots; a pair is counted once all the same."""
    rng = np.random.default_rng(17)
    base = rng.integers(-1, 2, (60, 64)).astype(float)
    rows = [v.tolist() for b in base for v in (b, np.where(rng.random(64) < 0.03, 0, b))]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = [{r.vec_id: r.n_links for r in pivots.near_duplicates(df.repartition(n)).collect()} for n in (1, 7)]
    assert got[0] == got[1]
    want = brute_links(rows)
    assert all(got[0][i] <= want[i] for i in got[0]) and sum(got[0].values()) >= 0.95 * sum(want.values())
