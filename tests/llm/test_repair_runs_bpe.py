"""Conversation repair, periodic runs and rank-array BPE against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from emporia.llm import bpe, repair, runs
from emporia.llm.queries import QUERIES, tokenizer_json

SMALL = "/root/testdata/sf0.001"
CLASH = "doc_id long, text string, ids string, decoded string, runs string, collapsed string, n_words string, _w string, _h string"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# --- BPE -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(tokenizer_json())


def odd_texts():
    rng = random.Random(7)
    return [
        "",
        "a",
        "<|endoftext|>",
        "x<|endoftext|> y<|endo<|endoftext|><|endoftext|>",
        "   a  b\n\n c\t\t",
        "it's I'LL we're they'd 's",
        " " * 3000,
        "ab" * 5000,
        "漢字" * 300 + " é\u0085\xa0 \x1c",
        "".join(chr(rng.randrange(0x20, 0x3000)) for _ in range(4000)),
        "".join(a + chr(c) + b for c in range(0x558, 0x33500, 37) if not 0xD800 <= c < 0xE000 for a, b in [("a", "1"), (" ", "")]),
        "".join(rng.choice("aeiou ' s\n1.") for _ in range(5000)),
        "".join(rng.choice("abcdefghijklmnop") for _ in range(3000)),
    ]


def test_encoder_equals_library(library):
    merges = bpe.read_merges(tokenizer_json())
    texts = odd_texts()
    for ids, text in zip(bpe.Encoder(merges).encode(texts), texts, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert bpe.decode_ids(merges.token_bytes, ids) == library.decode(want, skip_special_tokens=False)


def test_short_and_long_words_agree():
    merges = bpe.read_merges(tokenizer_json())
    rank = bpe.Encoder(merges).rank
    rng = random.Random(3)
    words = [bytes(rng.choice(b"etaoin shrdlu\xc3\xa9") for _ in range(rng.randrange(1, 65))) for _ in range(400)]
    assert bpe.merge_short(merges, words) == [bpe.merge_long(merges, rank, w) for w in words]
    assert bpe.merge_short(merges, []) == []


def test_broken_ids_decode_like_the_library(library):
    merges = bpe.read_merges(tokenizer_json())
    rng = random.Random(5)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(0, 12))]
        assert bpe.decode_ids(merges.token_bytes, np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_words_kept_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_WORDS", 50)
    encoder = bpe.Encoder(bpe.read_merges(tokenizer_json()))
    texts = [f"word{i} and w{i % 7}" for i in range(400)]
    assert [x for t in texts for x in encoder.encode([t])] == bpe.Encoder(encoder.merges).encode(texts)
    assert len(encoder.known) <= 60


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.read_merges(tokenizer_json("/opt/tokenizers/word_bpe_49k.json"))


def test_bpe_rows(spark, library):
    rows = [(1, None), (2, ""), (3, "same text"), (3, "same text"), (None, "no id"), (4, "x " * 50_000)]
    docs = spark.createDataFrame([(i, t, *["clash"] * 7) for i, t in rows], CLASH).repartition(3)
    got = bpe.decode_texts(bpe.encode_texts(docs, tokenizer_json()), tokenizer_json())
    assert got.columns == [c for c in docs.columns if c not in ("ids", "decoded")] + ["ids", "decoded"]
    assert sorted((r.doc_id, r.decoded, len(r.ids) // 4) for r in got.collect() if r.doc_id) == sorted((i, t or "", len(library.encode(t or "").ids)) for i, t in rows if i)
    assert bpe.round_trip_digest(docs.limit(0), tokenizer_json()).count() == 0


def test_bpe_query(spark, library):
    got = {r.doc_id: r for r in QUERIES["op13_rank_array_bpe"](spark, SMALL).collect()}
    docs = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False)))


# --- Periodic runs ---------------------------------------------------------------------


def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def repetitive(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        t = []
        for _ in range(rng.randrange(0, 6)):
            block = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 20))]
            t += block * rng.randrange(1, 9) + [rng.randrange(30) for _ in range(rng.randrange(0, 9))]
        yield t
    yield from ([1] * 500, [1, 2] * 300, [], [1], [1, 1, 2] * 40 + [1, 1, 2, 1, 1], [3] * 23, [3] * 24)


@pytest.mark.parametrize("most", [50, 400_000])
def test_find_runs(monkeypatch, most):
    monkeypatch.setattr(runs, "CANDIDATES", most)
    texts = list(repetitive(5, 120))
    bounds = np.cumsum([0, *map(len, texts)])
    got = runs.find_runs(np.array([x for t in texts for x in t], np.int64), bounds)
    assert [tuple(r) for r in got.tolist()] == [(k, *r) for k, t in enumerate(texts) for r in brute_runs(t)]


def test_extensions_of_random_places():
    rng = np.random.default_rng(2)
    symbols = np.concatenate([rng.integers(0, 3, 700), np.tile(rng.integers(0, 3, 40), 20), [0] * 300, [9]])
    levels = runs.compress(symbols)
    assert len(levels[-1].symbol) == 1
    a = rng.integers(0, len(symbols) - 1, 3000)
    b = np.array([rng.integers(x + 1, len(symbols)) for x in a])

    def agree(x, y):
        n = 0
        while y + n < len(symbols) and symbols[x + n] == symbols[y + n]:
            n += 1
        return n

    assert runs.extensions(levels, a, b).tolist() == [agree(x, y) for x, y in zip(a, b, strict=True)]


def test_run_rows(spark):
    beat = "tick tock\n" * 20
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, beat), (4, beat), (None, beat), (5, " ".join(f"w{i % 9000}" for i in range(30_000))), (6, "é" + " same" * 40)]
    docs = spark.createDataFrame([(i, t, *["clash"] * 7) for i, t in rows], CLASH).repartition(3)
    out = runs.word_runs(docs)
    assert out.columns == ["doc_id", "ids", "decoded", "_w", "_h", "n_words", "runs", "collapsed"]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()), key=str)
    want = [(i, len((t or "").split()), brute_runs((t or "").split()) if i != 5 else [(0, 30_000, 9000)]) for i, t in rows]
    want = [(i, n, found, " ".join(collapsed((t or "").split(), found))) for (i, n, found), (_, t) in zip(want, rows, strict=True)]
    assert got == sorted(want, key=str)
    assert runs.run_digest(runs.plant_runs(docs.limit(0))).count() == 0


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def test_runs_query(spark):
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    docs = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    assert len(got) == len(docs)
    total = 0
    for d in docs:
        w = planted(d["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", d["text"] or ""))
        if len(w) > 4000:
            continue
        found, r = brute_runs(w), got[d["doc_id"]]
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert (r.n_runs, r.runs_sha256) == (len(found), sha("".join("%d,%d,%d\n" % x for x in found)))
        assert r.collapsed_sha256 == sha(" ".join(collapsed(w, found)))
        total += len(found)
    assert total > 5


# --- Conversation repair ------------------------------------------------------------


NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def brute_repair(rows):
    """The cheapest edits by a table over (row, last role kept), audits compared whole."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\r\x0b\x0c")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    def put(table, state, cost, audit, kept):
        if state not in table or (cost, audit) < table[state][:2]:
            table[state] = (cost, audit, kept)
            return True
        return False

    def with_inserts(table):
        while any([put(table, n, c + 2, a + "I", k + [(role, "")]) for s, (c, a, k) in list(table.items()) for n, role in (("u", "user"), ("a", "assistant")) if n in NEXT[s]]):
            pass
        return table

    table = with_inserts({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        more = 1 if fault == "truncated" else 0
        for s, (c, a, k) in table.items():
            put(new, s, c + 3, a + "D", k)
            if fault in ("blank", "duplicate"):
                continue
            if role[:1] and role[0] in NEXT[s]:
                put(new, role[0], c + more, a + "K", k + [(role, text)])
            for n, name in (("u", "user"), ("a", "assistant")):
                if n in NEXT[s]:
                    put(new, n, c + 2 + more, a + "R", k + [(name, text)])
        table = with_inserts(new)
    cost, audit, kept = min((table[s] for s in ("", "a") if s in table), key=lambda x: x[:2])
    turns = [t for t, _, _ in rows if t is not None]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:], strict=False)),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": sha("\n".join(f"{r}:{t}" for r, t in kept)),
    }


def brute_digest(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            own += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return {c: brute_repair(sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))) for c, v in out.items()}


def same_digest(df, rows):
    got = {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in df.collect()}
    assert got == brute_digest(rows)


def test_vertices_and_slack():
    lr = repair.Automaton()
    names = set(lr.vertices())
    assert names == {"", "s", "u", "su", "B", "sB", "Bu", "sBu"}
    assert {n for n, v in lr.vertices().items() if lr.accepts(v)} == {"", "B", "sB"}


def test_chained_stretches_equal_one_parse():
    rng = random.Random(11)
    lr = repair.Automaton()
    for _ in range(150):
        rows = [(rng.choice("suaaux"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(0, 30))]
        whole = repair.Parse(lr)
        for r in rows:
            whole.row(*r)
        cuts = sorted(rng.randrange(0, len(rows) + 1) for _ in range(3))
        stretches = []
        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            paths = []
            for name, v in lr.vertices().items():
                p = repair.Parse(lr, v)
                for r in rows[a:b]:
                    p.row(*r)
                paths += [{"enter": name, "leave": lr.name(w), "cost": c, "audit": x} for w, c, x in p.results()]
            stretches.append(paths)
        assert repair.chained(lr, stretches) == repair.accepted(whole)


def test_repair_rows(spark):
    """Nulls anywhere, ties, equal rows, foreign roles, and one conversation over all tasks."""
    rng = random.Random(3)
    rows = []
    for c in [None, *range(50), 777]:
        large = c == 777
        for _ in range(1500 if large else rng.randrange(0, 14)):
            text = rng.choice([f"{i}{e}" for i in range(700) for e in ".!a"] if large else [None, "", " \n", "Yes.", "no", "Ok!", "really?", "é "])
            rows.append((c, rng.choice([None, *range(2500 if large else 9)]), rng.choice([None, "user", "assistant", "system", "tool", "User", ""]), text))
    rows += rows[:40]
    df = spark.createDataFrame([(*r, "x", "y", 5) for r in rows], "conv_id long, turn long, role string, text string, again string, _key string, cost long").repartition(5)
    same_digest(repair.repair_digest(df), rows)


def test_repair_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair_digest(none).count() == 0
    dropped = next((c, t) for c in range(99) for t in range(99) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    one = [(*dropped, "user", "Gone.")]
    same_digest(repair.repair_digest(spark.createDataFrame(one, "conv_id long, turn long, role string, text string")), one)


def test_repair_query(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SMALL}/conversations.parquet").to_pylist()]
    same_digest(QUERIES["op11_glr_repair"](spark, SMALL), rows)
