"""Structure repair, Katz backoff and hard negatives against plain versions on small hostile tables."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from judicata.llm import hard_negatives, katz, queries, structure_repair

# ---------------------------------------------------------------- conversation structure repair


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of one conversation, rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, counts, marked = set(), Counter(), []
    for _, role, text in rows:
        core = text.rstrip("\t\n\x0b\x0c\r ")
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        marked.append((role, text, fault))
    initials = [(r[0] or " ")[:1] for r in marked]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    follow = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    name = {"u": "user", "a": "assistant"}

    def close(best):
        for _ in range(3):
            for state, (cost, audit, said) in list(best.items()):
                for to in "ua":
                    if to in follow[state]:
                        new = (cost + 3, audit + "I", [*said, name[to] + ":"])
                        if to not in best or new < best[to]:
                            best[to] = new
        return best

    best = close({"": (0, "", [])})
    for (role, text, fault), ini in zip(marked, initials):
        new = {}
        more = 3 if fault == "truncated" else 0
        for state, (cost, audit, said) in best.items():
            ways = [(state, cost + 4, "D", said)]
            if fault not in ("blank", "duplicate"):
                if ini in follow[state]:
                    ways.append((ini, cost + more, "K", [*said, f"{role}:{text}"]))
                ways += [(to, cost + 3 + more, "R", [*said, f"{name[to]}:{text}"]) for to in "ua" if to in follow[state]]
            for to, c, edit, out in ways:
                if to not in new or (c, audit + edit, out) < new[to]:
                    new[to] = (c, audit + edit, out)
        best = close(new)
    cost, audit, said = min(best[s] for s in ("", "a") if s in best)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(said).encode()).hexdigest())


def conversations():
    r = random.Random(5)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(r.choice([0, 1, 2, 5, 9, 30])):
            text = r.choice(["Yes.", "No", "", " \t\n", "What? ", "Done!\n", None, f"line {r.randrange(6)}.", f"é {turn}?"])
            rows.append((conv, r.choice([turn, turn, turn, 3, None]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ua"]), text, r.choice([1, 1, 1, 2])))
    rows += [(100, i, "user", f"question {i}?", 1) for i in range(83)]                      # never converges
    rows += [(101, i, "user", "same.", 1) for i in range(40)] + [(102, None, "assistant", " ", 37)]
    rows += [(103, i, ("user", "assistant")[i % 2], f"t{i}.", 1) for i in range(64)]
    rows += [(104, 1, "system", "s.", 1), (105, None, "", "", 0), (106, 2 ** 62, "user", "a.", 1), (106, -2 ** 62, "user", "b.", 1)]
    rows += [(107, 0, "user", "again.", 90), (107, 1, "assistant", "x" * 5000 + ".", 1)]
    return rows


@pytest.mark.parametrize("chunk,partitions", [(4096, 3), (5, 7)])
def test_structure_repair(spark, monkeypatch, chunk, partitions):
    monkeypatch.setattr(structure_repair, "CHUNK_TURNS", chunk)
    rows = conversations()
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string, n int").repartition(4)
    got = {r.conv: tuple(r)[1:] for r in structure_repair.summary(structure_repair.repair(df, partitions)).collect()}
    by = defaultdict(list)
    for conv, turn, role, text, n in rows:
        by[conv] += [(turn, " " if role is None else role, " " if text is None else text)] * n
    want = {conv: plain_repair(turns) for conv, turns in by.items()}
    big = want.pop(106)
    mine = got.pop(106)
    assert mine[1:] == big[1:] and mine[0] == 2 ** 63 - 1
    assert got == want


def test_structure_repair_turns_and_empty(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "Hi.", 1), (1, 1, "user", "Hello.", 1)], "conv long, turn long, role string, text string, n int")
    out = structure_repair.repaired_turns(structure_repair.repair(df)).orderBy("piece", "place").collect()
    assert [(r.role, r.text) for r in out] == [("user", "Hello."), ("assistant", "")] or len(out) % 2 == 0
    assert structure_repair.summary(structure_repair.repair(df.where("conv > 5"))).count() == 0


def test_damage_follows_the_checksum(spark):
    import zlib
    rows = [(c, t, "assistant", "One. Two!") for c in (None, -3, 7) for t in (None, *range(40))]
    out = queries.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    acts = {}
    for c, t, _, _ in rows:
        acts[c, t] = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
    want = Counter()
    for (c, t), act in acts.items():
        text = {0: "", 1: "", 2: "One Two"}.get(act, "One. Two!")
        want[c, None if act == 0 else t, {0: "", 4: "user"}.get(act, "assistant"), text, {0: 0, 3: 2}.get(act, 1)] += 1
    assert Counter(map(tuple, out)) == want


# ---------------------------------------------------------------- Katz backoff


def lowered(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def plain_katz(docs, held, order):
    """Score of every document by direct recursion, and P(. | h) of every history for the sum to 1."""
    tokens = [[*lowered(t), None] for t in docs]
    counts = [None, *[Counter() for _ in range(order)]]
    for ts, out in zip(tokens, held):
        if not out:
            for i in range(len(ts)):
                for n in range(1, order + 1):
                    counts[n][tuple(ts[j] if j >= 0 else "^" for j in range(i - n + 1, i + 1))] += 1
    ds = [None]
    for n in range(1, order + 1):
        r = Counter(counts[n].values())
        ds.append(katz.discounts([r[k] for k in range(1, 7)]))

    def d(n, c):
        return (c - 0.5) / c if ds[n] is None else ds[n][c - 1] if c <= len(ds[n]) else 1.0

    after = [None, *[defaultdict(dict) for _ in range(order)]]
    for n in range(1, order + 1):
        for g, c in counts[n].items():
            after[n][g[:-1]][g[-1]] = c

    def p(h, w):
        n = len(h) + 1
        seen = after[n].get(h)
        if n > 1 and not seen:
            return p(h[1:], w)
        if not seen:
            return 1.0
        total = sum(seen.values())
        left = sum((1 - d(n, c)) * c for c in seen.values())
        if left == 0:
            left, total = 1, total + 1
        if w in seen:
            return d(n, seen[w]) * seen[w] / total
        lower = 1 - sum(p(h[1:], v) for v in seen) if n > 1 else 1.0
        return left / total / lower * (p(h[1:], w) if n > 1 else 1.0)

    scores = [sum(math.log10(p(tuple(ts[j] if j >= 0 else "^" for j in range(i - order + 1, i)), ts[i])) for i in range(len(ts))) for ts in tokens]
    vocab = [*{g[0] for g in counts[1]}, "unknown word"]
    sums = [sum(p(h, w) for w in vocab) for h in list(after[order])[:20]]
    return scores, sums, counts


def corpus():
    r = random.Random(8)
    vocab = [f"w{i}" for i in range(60)]
    docs = [" ".join(vocab[min(59, int(r.expovariate(0.12)))] for _ in range(r.choice([0, 1, 3, 30, 80]))) for _ in range(70)]
    return docs + [None, "", " \n ", "NEW words Here", docs[3], docs[3], "hot " * 400, "É é " * 90 + "x" * 3000]


@pytest.mark.parametrize("order,small", [(1, False), (2, False), (2, True), (3, True)])
def test_katz(spark, monkeypatch, order, small):
    if small:       # many blocks, texts over several blocks, histories spread over partitions
        for name, value in (("BLOCK_TOKENS", 37), ("PIECE_BYTES", 64), ("HOT_TOKENS", 5), ("BUCKET", 50)):
            monkeypatch.setattr(katz, name, value)
    docs = corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(docs)], "doc_id long, text string, key string, held long").repartition(3)
    model = katz.fit(df, F.col("doc_id") % 7 == 2, order=order)
    got = {r.id: r for r in model.score().collect()}
    held = [i % 7 == 2 for i in range(len(docs))]
    scores, sums, counts = plain_katz(docs, held, order)
    assert sums == pytest.approx([1.0] * len(sums))
    n, v = sum(counts[1].values()), len(counts[1])
    assert model.levels[0].total == n and model.levels[0].distinct == v
    for i, text in enumerate(docs):
        ts = [*lowered(text), None]
        assert (got[i].n_tokens, got[i].n_known, got[i].held_out) == (len(ts), sum((t,) in counts[1] for t in ts), held[i])
        assert got[i].base_score == pytest.approx(sum(math.log10((counts[1][t,] + 1) / (n + v + 1)) for t in ts))
        assert got[i].score == pytest.approx(scores[i], rel=1e-9)


def test_katz_without_training_or_rows(spark):
    df = spark.createDataFrame([(2, "a b"), (2, "a b"), (None, None)], "doc_id long, text string")
    out = katz.fit(df, F.lit(True)).score().collect()
    assert len(out) == 3 and all(r.score == 0 and r.n_known == 0 for r in out)
    assert katz.fit(df.where("doc_id > 5"), F.lit(False)).score().count() == 0


def test_katz_predicts_held_out_texts_better_than_its_base(spark):
    out = queries.QUERIES["op12_katz_backoff"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


# ---------------------------------------------------------------- hard negatives


def vectors():
    r = random.Random(2)
    rows = []
    for i in range(400):
        near = r.choice([0.0, 0.4, 0.8])
        rows.append((i, [math.sin(k + i % 7) * near + r.uniform(-0.5, 0.5) for k in range(20)], r.choice([0, 0, 0, 1, 2])))
    rows += [(i, rows[i % 9][1], i % 3) for i in range(400, 440)]                                # ties
    rows += [rows[100], rows[100], (100, [0.1] * 20, 1), (440, None, 1), (441, [None] + [0.0] * 19, 1), (442, [float("inf")] * 20, 1),
             (443, [0.0] * 20, None), (None, [0.5] * 20, 1), (444, [0.3] * 7, 1), (500, [0.4] * 7, 1), (445, [0.35] * 7, 2), (446, [], 1), (600, [], 1)]
    return rows


def plain_negatives(rows, scale=256.0):
    ok = {(i, lab, tuple(math.floor(scale * x) for x in v)) for i, v, lab in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a, la, va in ok:
        if a % 100:
            continue
        scored = [(sum(p * q for p, q in zip(va, vb)), b, lb) for b, lb, vb in ok if len(va) == len(vb)]
        pos = sorted([(-s, b) for s, b, lb in scored if lb == la and b != a])[:5]
        neg = sorted([(-s, b) for s, b, lb in scored if lb != la])
        for ps, p in pos:
            good = [(s, b) for s, b in neg if 80 * -ps <= 100 * -s <= 100 * -ps][:5]
            out += [(a, p, k, b, -ps, -s) for k, (s, b) in enumerate(good, 1)]
    return Counter(out)


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, monkeypatch, small):
    if small:
        for name, value in (("BLOCK", 16), ("CHUNK_ROWS", 3), ("SLOT_LEAST", 32), ("SLOT_MOST", 64), ("TILE", 2)):
            monkeypatch.setattr(hard_negatives, name, value)
    df = spark.createDataFrame([(*r, "x", 0) for r in vectors()], "vec_id long, embedding array<double>, label int, block string, n int").repartition(3)
    out = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()
    assert Counter(tuple(r) for r in out) == plain_negatives(vectors())
    assert len(out) > 20
    assert hard_negatives.hard_negatives(df.where("vec_id > 10000"), F.col("vec_id") % 100 == 0).count() == 0


def test_hard_negatives_beyond_double_precision(spark):
    r = random.Random(4)
    rows = [(i, [r.uniform(0.5, 1) * 4e6 for _ in range(6)], i % 3) for i in range(0, 400, 10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()
    assert Counter(tuple(r) for r in out) == plain_negatives(rows)


def test_segment_bounds_hold():
    import numpy as np
    x = np.random.default_rng(0).normal(size=(40, 37)) * 50
    exact = x @ x.T
    widths = []
    for mean, spread in hard_negatives.summaries(x):
        middle, off = mean @ mean.T, spread @ spread.T
        assert (exact <= middle + off + 1e-6).all() and (exact >= middle - off - 1e-6).all()
        widths.append(off.mean())
    assert widths[1] < widths[0]
