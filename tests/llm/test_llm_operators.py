"""Operators against plain versions on small hostile tables: nulls, empty texts, ties, repeated rows, extra columns."""

import hashlib
import random
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from judicata.llm import chat, embeddings, line_dedup, mixing, ngram_join, packing, repetition, sharding, substring_dedup, toxicity
from judicata.operators import components


def texts(seed=1, n=60):
    r = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)]
    base = [" ".join(r.choice(vocab) for _ in range(r.randint(3, 120))) for _ in range(n // 3)]
    out = []
    for i in range(n):
        t = r.choice(base).split(" ")
        for _ in range(r.randint(0, 6)):
            t[r.randrange(len(t))] = r.choice(vocab)
        out.append(" ".join(t) if i % 3 else "\n".join(" ".join(t[k:k + 9]) for k in range(0, len(t), 9)))
    out += [None, "", "   \n ", out[0], out[0], " ".join(["same"] * 90), "a b c É é", "x " * 3000]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in texts()]
    return spark.createDataFrame(rows, "doc_id long, text string, id string").repartition(3)


def words(t):
    return (t or "").encode().split()


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


@pytest.mark.parametrize("hot", [10**9, 1])
def test_substring_dedup(spark, docs, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_COUNT", hot)      # 1: every repeated anchor is split by window
    width, seen, want = 20, set(), {}
    for i, t in texts():
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            key = tuple(w[p:p + width])
            if key in seen:
                gone[p:p + width] = [True] * width
            seen.add(key)
        want[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g))
    whole, cut = substring_dedup.substring_dedup(docs, shard_words=500)
    got = {r.id: (r.n_words, 0, r.kept_sha256) for r in whole.collect()}
    got |= {r.id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in cut.collect()}
    assert got == {i: (n, g, hashlib.sha256(k).hexdigest()) for i, (n, g, k) in want.items()}
    assert sum(x.count() for x in substring_dedup.substring_dedup(empty(spark))) == 0


def test_repetition(spark, docs):
    rows = repetition.quality_rules(repetition.repetition_features(docs)).collect()
    for r in rows:
        w = words(dict(texts())[r.doc_id])

        def mask(k):
            at = {}
            for p in range(len(w) - k + 1):
                at.setdefault(tuple(w[p:p + k]), []).append(p)
            return {q for ps in at.values() if len(ps) > 1 for p in ps for q in range(p, p + k)}
        assert (r.n_words, r.n_repeat_words, r.n_covered) == (len(w), len(mask(5)), len(mask(10)))
        longest = next((k for k in range(1, len(w) + 1) if not mask(k)), len(w) + 1) - 1 if len(w) < 500 else r.longest_repeat
        assert r.longest_repeat == max(0, longest)
    assert not any(r.kept for r in rows if r.n_words < 10)
    assert repetition.repetition_features(empty(spark)).count() == 0


def test_quotation_linking(spark):
    rows = [(1, 0, "u", "Hello there, how are you today?"), (1, 1, "a", "Something unrelated entirely"),
            (1, 2, "u", "Bob wrote:\n> hello there,  how are\n> you today?\nfine thanks"),
            (1, 3, "a", ">> Hello there, how are you today?\n> fine thanks\nok then"), (1, 4, "u", None),
            (1, 5, "u", "> no such original text"), (None, 0, "u", "x"), (2, 0, "u", ""), (2, 0, "u", ""),
            (2, None, "u", "> Hello there, how are you today?")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.reply_ordered(df).collect()
    by = {(r.conv_id, r.turn): r for r in out}
    assert len(out) == len(rows)
    assert by[1, 2].parent_turn == 0 and by[1, 2].text == "fine thanks" and by[1, 2].n_quoted == 2
    assert by[1, 3].parent_turn == 2 and by[1, 3].text == "ok then"
    assert by[1, 4].text is None and by[1, 5].text == "" and by[1, 5].parent_turn is None
    order = [r.turn for r in sorted((r for r in out if r.conv_id == 1), key=lambda r: r.position)]
    assert order == [0, 2, 1, 3, 4, 5]
    assert sorted(r.position for r in out if r.conv_id == 2) == [0, 1, 2]


def test_ngram_join(spark, docs):
    sets = {}
    for i, t in texts():
        w = [x.lower() if x.isascii() else x for x in words(t)]
        sets[i] = {tuple(w[p:p + 5]) for p in range(len(w) - 4)} or ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    label[a] = label[b] = min(label[a], label[b])
        if _ > 8:
            break
    for hot in (64, 1, 0):
        got = {r.id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_jaccard_join(docs, hot=hot).collect()}
        assert got == {i: (len(s), label[i]) for i, s in sets.items()}
    assert ngram_join.ngram_jaccard_join(empty(spark)).count() == 0


def test_ngram_join_families_near_the_threshold(spark):
    rng, rows, sets = random.Random(5), [], {}
    for f in range(4):
        base = [f"w{rng.randrange(4000)}" for _ in range(120)]
        for k in range(45):
            w = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 2, 3))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(w[:rng.choice((120, 120, 110, 95))])))
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[p:p + 5]) for p in range(len(w) - 4)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert 4 < len({find(i) for i in sets}) < len(sets)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for hot, block in ((64, 1000), (4, 10 ** 6)):
        got = {r.id: r.component_id for r in ngram_join.ngram_jaccard_join(df, hot=hot, block_grams=block).collect()}
        assert got == {i: find(i) for i in sets}


def test_ngram_join_lone_pairs_where_one_holds_the_other(spark):
    rng, rows, want = random.Random(9), [], {}
    for n in [250, 300, 310, 350, 400, 450, 510, 600] * 3 + [1000, 1500, 2000, 2500, 3000]:
        for share in (73, 75, 76, 78, 80, 85):
            small = -(-share * n // 100)
            w = [f"p{len(rows)}x{k}" for k in range(n + 4)]
            at = rng.randrange(n - small + 1)
            a = len(rows)
            rows += [(a, " ".join(w)), (a + 1, " ".join(w[at:at + small + 4]))]
            want |= {a: a, a + 1: a if 100 * small >= 75 * n else a + 1}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component_id for r in ngram_join.ngram_jaccard_join(df).collect()}
    assert got == want


def test_ngram_join_ids_that_hold_two_texts(spark):
    rows, want = [], {}
    for i in range(20):
        for k in (1, 2):
            w = [f"t{i}x{k}x{j}" for j in range(40 + i)]
            rows += [(i, " ".join(w)), (100 * k + i, " ".join(w[1:]))]
            want |= {i: i, 100 * k + i: i}
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component_id for r in ngram_join.ngram_jaccard_join(df).collect()}
    assert got == want


class _Frame:
    """Stands for a frame and hands out the function that mapInArrow gets."""

    def __getattr__(self, name):
        return lambda *a: a[0] if name == "mapInArrow" else self


def _peak(work, batches):
    """Rows of the result, and MB that Python held at most beyond its input."""
    rows = []
    tracemalloc.start()
    for b in work(iter(batches)):
        rows += b.to_pylist()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return rows, peak


def test_ngram_join_sorts_a_bucket_in_slices():
    """A full bucket: 1.2 million entries in blocks of several tasks, one hash of many classes among them."""
    r, blocks, want = np.random.default_rng(8), [], {}
    lone = r.permutation(1 << 22)[:1_190_000].astype(np.uint64) * np.uint64(1 << 20) + np.uint64(1 << 19)
    lone[:100] = lone[100:200]                          # 100 hashes that two classes share
    for t in range(6):
        h = np.concatenate((lone[t::6], np.full(1500, 77, dtype=np.uint64)))
        ref = (np.arange(len(h)) % 2000).astype("<u2")
        order = np.lexsort((ref, h))
        cls = np.arange(2000, dtype="<i8") + 2000 * t
        blocks.append((0, h[order].tobytes(), ref[order].tobytes(), ref[order].tobytes(), cls.tobytes(), (cls + 5).tobytes()))
        for x, k in zip(h.tolist(), cls[ref].tolist()):
            want.setdefault(x, set()).add(k)
    want = {x: k for x, k in want.items() if len(k) > 1}
    zones = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*blocks), (pa.int32(), *[pa.binary()] * 5))],
                            names=["bucket", "h", "ref", "rank", "cls", "n"])
    rows, peak = _peak(ngram_join._shared(_Frame(), 64, 3), [zones])
    got = {}
    for x in rows:
        c, n = (np.frombuffer(x[k], "<i8") for k in ("cls", "n"))
        assert (c % 3 == x["cb"]).all() and (n == c + 5).all() and (np.diff(c) >= 0).all()
        assert (np.frombuffer(x["hot"], "?") == (np.frombuffer(x["h"], "<u8") == 77)).all()
        for h, k in zip(np.frombuffer(x["h"], "<u8").tolist(), c.tolist()):
            assert k not in got.setdefault(h, set())
            got[h].add(k)
    assert got == want and len(want[77]) == 9000
    assert peak < 60


def test_ngram_join_slices_keep_equal_keys_together():
    r = np.random.default_rng(2)
    keys = [np.sort(r.integers(0, 500, k)) for k in (0, 1, 3000, 7000, 40)] + [np.full(4000, 123)]
    seen, sizes = [], []
    for cut in ngram_join._slices(keys, 1000):
        part = np.concatenate([k[s] for k, s in zip(keys, cut)])
        sizes.append(len(part))
        seen.append(set(part.tolist()))
    assert sum(sizes) == sum(map(len, keys)) and sum(map(len, seen)) == len(set().union(*seen))
    assert sorted(sizes)[-2] < 1500 and max(sizes) < 5500
    assert list(ngram_join._slices([np.zeros(0, dtype=np.int64)], 10)) == [[slice(0, 0)]]


def test_ngram_join_zones_in_bounded_memory():
    """Texts of 12 MB in one batch leave as several blocks, a copied text once."""
    r = np.random.default_rng(4)
    texts = [" ".join(f"{x:x}" for x in r.integers(0, 1 << 30, 1500)) for _ in range(1000)]
    batch = pa.record_batch([pa.array(texts + texts[:50])], names=["text"])
    rows, peak = _peak(ngram_join._zones(_Frame(), 5, 75, 4), [batch])
    p = ngram_join.prefix_length(1496, 75) + ngram_join.margin(1496, 75)
    assert sum(len(x["h"]) // 8 for x in rows) == 1000 * p
    assert len({c for x in rows for c in np.frombuffer(x["cls"], "<i8").tolist()}) == 1000
    assert peak < 75


def test_embeddings(spark):
    r = np.random.default_rng(3)
    base = r.standard_normal((40, 16))
    x = np.repeat(base, 10, axis=0) + 0.12 * r.standard_normal((400, 16))
    rows = [(i, x[i].tolist(), int(i % 10 > 6)) for i in range(400)]
    rows += [(400, rows[0][1], rows[0][2]), (401, None, 0), (402, [0.0] * 16, 0), (403, [float("nan")] * 16, 0),
             (404, rows[1][1], None), (405, [1.0, 2.0], 0), (406, [2.0, 4.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = {r.vec_id: r for r in embeddings.near_duplicates(df, leaf_rows=40, block_rows=16).collect()}
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    lab = np.array([row[2] for row in rows[:400]])
    link = (y @ y.T >= 0.93) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(link, False)
    want = link.sum(axis=1) + link[:, 0] + (np.arange(400) == 0)
    found = sum(out[i].n_links for i in range(400))
    assert 0.9 * want.sum() <= found <= want.sum() and len(out) == len(rows)
    assert all(out[i].n_links <= want[i] for i in range(400))
    assert [out[i].n_links for i in range(401, 407)] == [0, 0, 0, 0, 1, 1] and out[406].component_id == 405
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.values())


def test_components_chain(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_line_dedup(spark):
    line = "A line that many documents share"
    rows = [(1, f"x\n {line} \ny"), (2, line.lower()), (3, f"{line}\n{line}\nz"), (3, f"{line}\n{line}\nz"), (4, None), (5, ""),
            (None, line), (6, "short\nshort"), (7, "short")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, drop string")
    out = line_dedup.line_dedup(df)
    got = sorted(((r.doc_id or 0), r.kept_text, r.n_lines, r.n_dropped) for r in out.where("doc_id <> 4 OR doc_id IS NULL").collect())
    assert got == sorted([(1, "x\ny", 3, 1), (2, "", 1, 1), (3, rows[2][1], 3, 0), (3, rows[2][1], 3, 0), (5, "", 1, 0),
                          (0, line, 1, 0), (6, "short\nshort", 2, 0), (7, "short", 1, 0)])
    assert out.where("doc_id = 4").first().kept_text is None and "drop" in out.columns


def test_sharding(spark, docs):
    import xxhash
    out = sharding.shard_documents(docs, [1.0] * 7).collect()

    def pick(key, n):
        def u(s):
            h = xxhash.xxh64(key.to_bytes(8, "little"), seed=42).intdigest()
            h = xxhash.xxh64(s.to_bytes(4, "little"), seed=h).intdigest()
            return (h >> 11, -s)
        return max(range(n), key=u)
    for r in out:
        t = (dict(texts())[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.shard, r.grown_shard) == (len(t) + 16, zlib.crc32(t), pick(r.doc_id, 7), pick(r.doc_id, 8))
        assert r.grown_shard in (r.shard, 7)
    for s in range(7):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))


def test_mixing(spark):
    r = random.Random(5)
    rows = [(i, r.choice(["a", "b", "c", None]), r.randint(0, 30)) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, source string, words long")
    mixed, sources = mixing.mix(df, F.array("source"), F.col("words"))
    target = {s.source: (s.source_size, s.target) for s in sources.collect()}
    taken = {}
    for x in mixed.collect():
        assert 0 <= x.copies <= 2
        taken[x.source] = taken.get(x.source, 0) + x.copies * x.size
    total = sum(w for *_, w in rows)
    assert abs(sum(t for _, t in target.values()) - 1.5 * total) < 1e-6
    assert all(t <= 2 * n + 1e-9 and abs(taken[s] - t) <= 16 for s, (n, t) in target.items())
    again, _ = mixing.mix(df.repartition(5), F.array("source"), F.col("words"))
    assert sorted(again.select("doc_id", "copies").collect()) == sorted(mixed.select("doc_id", "copies").collect())
    # an overlapping pattern serves the source that lacks words
    assert mixing.min_cost_flow([(10.0, [0]), (10.0, [0, 1])], [10.0, 10.0], 2) == [10.0, 10.0]


def naive_best_fit(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [(c, k) for k, c in enumerate(room) if c >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(capacity - n)
    return len(room), sorted(room)


def test_best_fit_plan_equals_naive():
    r = random.Random(9)
    for _ in range(30):
        cap = r.randint(5, 60)
        lengths = [r.randint(1, cap) for _ in range(r.randint(0, 200))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        plan, used = packing.best_fit_plan(counts, cap), {}
        for n, _r0, k, seq, per, off in zip(*(plan[c].tolist() for c in ("length", "rank0", "n", "seq0", "per", "offset"))):
            for j in range(k):
                used.setdefault(seq + j // per, []).append((off + j % per * n, n))
        for places in used.values():
            places.sort()
            assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        bins = (len(used), sorted(cap - sum(n for _, n in p) for p in used.values()))
        assert bins == naive_best_fit(lengths, cap)


def test_packing(spark, docs):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows, seqs = {}, {}
    for r in packing.pack(docs, capacity=64).collect():
        rows.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, t in texts():
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        at = 0
        for k, r in enumerate(sorted(rows[i], key=lambda r: r.piece)):
            part = np.array(ids[at:at + r.length], dtype="<u4").tobytes()
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(part)) and r.length <= 64
            at += r.length
        assert at == len(ids)
    for places in seqs.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 64
    assert packing.default_encoder()("a <|endoftext|> b").tolist() == tok.encode("a <|endoftext|> b", add_special_tokens=False).ids
    assert packing.pack(empty(spark)).count() == 0


def test_toxicity_features_have_one_formula_and_linear_time():
    text = "You are NOT a moron, you IDIOT! "
    short, long = (toxicity.describe(text * k, frozenset()) for k in (5, 9))       # on both sides of 200 characters
    for name in ("seed", "near_you", "you", "capitals", "caps_words", "punctuation"):
        k = toxicity.FEATURES.index(name)
        assert short[k] == pytest.approx(long[k])
    low = "a b idiot c you d e f g moron h i j k l".split()
    hits, you = [2, 9], [4]
    got = toxicity.describe(" ".join(low), frozenset())[toxicity.FEATURES.index("near_you")]
    assert got == sum(any(abs(h - y) <= toxicity.NEAR for y in you) for h in hits) / len(low)
    began = time.time()
    toxicity.describe("you idiot " * 500_000, frozenset())
    assert time.time() - began < 30


def test_toxicity_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "you idiot", 7, "x"), (2, None, 8, "y")], "doc_id long, text string, seed long, `a.b` string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.fit(docs, labels).score(docs, ["doc_id", "seed", "a.b"])
    assert out.columns == ["doc_id", "seed", "a.b", "score", "predicted"]
    assert sorted((r[0], r[1], r[2]) for r in out.collect()) == [(1, 7, "x"), (2, 8, "y")]


def test_forest_below_its_fitted_levels():
    r = np.random.default_rng(1)
    x = r.standard_normal((3000, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    forest = embeddings._fit(x[:200], 2, 9, 5)
    assert forest["fitted"] == 3 and forest["centres"].shape == (2, 8, 8)
    rows, nodes = embeddings.leaves(x, forest, 1, 0.0)
    assert len(rows) >= len(x) and np.bincount(nodes).max() < 150 and (nodes >= 512).all()


def test_pipeline_keeps_different_texts_of_one_id(spark, monkeypatch):
    import corpus_pipeline
    a, b = " ".join("a%d" % i for i in range(40)), " ".join("b%d" % i for i in range(40))
    rows = [(1, a, "en", "s", 5), (1, b, "en", "s", 5), (1, a, "de", "s", 5), (2, a + " x", "en", "t", 6), (None, a, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text, r.lang) for r in got) == sorted([(1, a, "de"), (1, b, "en"), (0, a, "en")])
