"""Earlier operators against plain versions: planted quotes through the SQL, features, flow, and the pipeline's rows."""

import itertools
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from judicata.llm import mixing, queries, toxicity
from tools.oracle_check import digest


def planted_conversations():
    r = random.Random(11)
    said = ["The first plan is ready now", "We should meet again tomorrow", "no", "A longer line that wraps\nover two lines here", "Ende der Nachricht, danke!"]
    rows = []
    for conv in range(40):
        past = []
        for turn in range(r.choice([1, 4, 12])):
            own = r.choice(said) + r.choice(["", f" number {turn % 3}"])
            if past and r.random() < 0.7:
                quoted = r.choice(past)
                level = ">" * r.choice([1, 1, 2, 3]) + r.choice(["", " "])
                lines = quoted.replace("\n", r.choice(["\n", " "])).split("\n")
                text = r.choice(["", "Ana wrote:\n", "Max schrieb:\n"]) + "\n".join(level + (x.upper() if r.random() < 0.3 else x) for x in lines) + "\n" + own
            else:
                text = own
            rows.append((conv, turn, "user", r.choice([text, text, text, None, ""])))
            past.append(own)
    rows += [(100, t, "user", f"> reply to {t - 1} of the thread\nreply to {t} of the thread") for t in range(1500)]
    return rows


def test_planted_quotes_through_the_sql(spark, tmp_path):
    df = spark.createDataFrame(planted_conversations(), "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    out = queries.QUERIES["op3_quotation_linking"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    cur = con.execute(queries.ORACLE["op3_quotation_linking"])
    rows = [tuple(r) for r in out.collect()]
    assert digest(out.columns, rows)[0] == digest([d[0] for d in cur.description], cur.fetchall())[0]
    parents = [r[out.columns.index("parent_turn")] for r in rows]
    assert sum(p is not None for p in parents) > 1000


def plain_features(text, lexicon):
    words = text.split()
    n = max(1, len(words))
    bare = [w.strip(toxicity.EDGE) for w in text.lower().split()]
    in_prefix = [any(len(w) > k and w[:k] + "*" in lexicon for k in toxicity.PREFIXES) for w in bare]
    hit = [w in toxicity.SEED or p or w in lexicon for w, p in zip(bare, in_prefix)]
    seeds = sum(w in toxicity.SEED for w, h in zip(bare, hit) if h)
    near = sum(any(abs(i - j) <= toxicity.NEAR and v in toxicity.YOU for j, v in enumerate(bare)) for i, h in enumerate(hit) if h)
    you = sum(w in toxicity.YOU for w in bare) if any(hit) else 0
    visible = max(1, len(re.sub(r"\s", "", text)))
    upper = sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ" for c in text)
    return {"seed": seeds / n, "learned": (sum(hit) - seeds) / n, "learned_prefix": sum(p for p, h in zip(in_prefix, hit) if h) / n,
            "near_you": near / n, "you": you / n, "capitals": upper / visible, "punctuation": sum(c in ".,;:!?" for c in text) / n,
            "caps_words": sum(len(w) > 2 and w.isupper() for w in words) / n, "exclamations": text.count("!") / n}


def test_toxicity_features_against_plain_ones():
    r = random.Random(6)
    pool = ["you", "IDIOT!", "moron", "hello", "World.", "tus", "stup1d", "zork", "zorks", "É", "ok?", "a", "THE", "(loser)", "\n", "\t"]
    lexicon = frozenset({"zork", "hell*", "w0rld"})
    for _ in range(300):
        text = " ".join(r.choice(pool) for _ in range(r.choice([0, 1, 5, 40, 120])))
        got = dict(zip(toxicity.FEATURES, toxicity.describe(text, lexicon)))
        for name, value in plain_features(text, lexicon).items():
            assert got[name] == pytest.approx(value), (name, text)


def cheapest(patterns, targets, copies):
    """Largest flow and its least cost by trying every whole number of parts on every arc."""
    arcs = [(p, s) for p, (_, members) in enumerate(patterns) for s in members]
    best = (0, 0)
    for amounts in itertools.product(*[range(int(patterns[p][0]) * copies + 1) for p, _ in arcs]):
        used, filled = [0] * len(patterns), [0] * len(targets)
        for (p, s), x in zip(arcs, amounts):
            used[p] += x
            filled[s] += x
        if any(u > n * copies for u, (n, _) in zip(used, patterns)) or any(f > t for f, t in zip(filled, targets)):
            continue
        best = min(best, (-sum(amounts), sum(k // (int(n) // mixing.PARTS) for u, (n, _) in zip(used, patterns) for k in range(u))))
    return best


def test_flow_is_the_cheapest():
    r = random.Random(9)
    for _ in range(12):
        patterns = [(4.0, sorted(r.sample([0, 1], r.choice([1, 2])))) for _ in range(r.choice([1, 2, 3]))]
        while sum(len(m) for _, m in patterns) > 4:
            patterns.pop()
        targets = [float(r.randint(0, 9)) for _ in range(2)]
        taken = mixing.min_cost_flow(patterns, targets, 2)
        flow, cost = cheapest(patterns, targets, 2)
        assert sum(taken) == pytest.approx(-flow)
        assert sum(k for t in taken for k in range(round(t))) == pytest.approx(cost)


def test_pipeline_rows_stage_by_stage(spark):
    """Rows of the middle stages on sf0.001 against plain versions of their rules; the classifier's verdicts and the tokenizer are taken as given."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 120")
    before = {r.doc_id: r.text or "" for r in docs.collect()}
    lined = corpus_pipeline.materialise(corpus_pipeline.drop_common_lines(spark, docs, ""))
    strip = "\t\n\x0b\x0c\r "
    key = lambda x: "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in x.strip(strip))
    holders = {}
    for i, t in before.items():
        for line in t.split("\n"):
            holders.setdefault(key(line), set()).add(i)
    want = {i: "\n".join(x for x in t.split("\n") if len(key(x)) < 20 or len(holders[key(x)]) < 3 or i == max(holders[key(x)])) for i, t in before.items()}
    got = {r.doc_id: r.text or "" for r in lined.collect()}
    assert got == want
    sets = {}
    for i, t in got.items():
        w = ["".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in x) for x in re.findall(r"[^\x20\x09-\x0D]+", t)]
        sets[i] = {tuple(w[p:p + 5]) for p in range(len(w) - 4)} or ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in range(len(links) + 1):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    once = corpus_pipeline.materialise(corpus_pipeline.drop_near_duplicates(spark, lined, ""))
    assert sorted(r.doc_id for r in once.collect()) == sorted(i for i in label if label[i] == i) and len(links) > 0
    mixed = corpus_pipeline.materialise(corpus_pipeline.mix_sources(spark, once, ""))
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    size, taken = {}, {}
    for r in once.collect():
        size[r.source] = size.get(r.source, 0) + count(r.text)
    rows = mixed.collect()
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + count(r.text)
    names = sorted(size, key=lambda s: (s is None, s or ""))
    target = mixing.quotas(size, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, 1.5 * sum(size.values()), 2)
    longest = max(count(r.text) for r in once.collect())
    assert all(abs(taken.get(s, 0) - t) <= longest for s, t in target.items())
    assert mixed.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 2
    packed = corpus_pipeline.pack_sequences(spark, mixed, "")
    per = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"), F.min("offset").alias("at")).collect()
    assert all(p.n == p.end <= 1024 and p.at == 0 for p in per)
    assert packed.where("piece = 0").count() == len(rows)
