"""Fingerprints, links, retrieval, classifiers and the pipeline against plain versions of themselves."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import decontaminate, language, mixing, quality_cnn, quality_rules, simhash, toxicity
from tickloom.llm.queries import QUERIES, quality_model


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \x0b ", "One", "One TWO", "a b c", "É é Ä a\tb\nc\x1cd", "x y " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def near_fingerprints(rng, centres, around):
    found = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        found.add(c)
        for _ in range(around):
            x = c
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                x ^= 1 << b
            found.add(x)
    return sorted(found)


PLANS = [
    None,
    simhash.Plan((tuple(range(32)), tuple(range(32, 64))), (1, 0)),
    simhash.Plan((tuple(range(0, 64, 2)), tuple(range(1, 64, 2))), (2, -1)),
    simhash.Plan(tuple(tuple(range(i, 64, 4)) for i in range(4)), (0, -1, 0, 0)),
]


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("hot", [3, 10_000])
def test_links_and_components(spark, monkeypatch, plan, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    fps = near_fingerprints(random.Random(4), 12, 25) + [0, 1, 2**63, 2**64 - 1]
    plan = plan or simhash.make_plan(np.array(fps, np.uint64), len(fps))
    assert sum(t + 1 for t in plan.thresholds) == simhash.MAX_BITS + 1
    assert sorted(b for p in plan.parts for b in p) == list(range(64))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = {
        (min(a, b), max(a, b)) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    }
    pairs = simhash.links(df, plan)
    assert sorted((r.a, r.b) for r in pairs.collect()) == sorted(want)
    parent = {f: f for f in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in want:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in simhash.roots(pairs).collect()}
    assert got == {f: root(f) for pair in want for f in pair if f != root(f)}


def test_a_long_chain_is_one_component(spark):
    chain = [(i, i + 1) for i in range(200)]
    got = simhash.roots(spark.createDataFrame(chain, "a long, b long")).collect()
    assert len(got) == 200 and {r.root for r in got} == {0}


def test_allocation_is_the_cheapest():
    rng = random.Random(5)
    for _ in range(50):
        m = rng.randrange(1, 5)
        costs = [[0.0, *[rng.random() for _ in range(3)]] for _ in range(m)]
        best = min(sum(costs[i][u] for i, u in enumerate(c)) for c in itertools.product(range(4), repeat=m) if sum(c) == 3)
        got, thresholds = simhash.allocate(costs, 3)
        assert got == pytest.approx(best) and sum(t + 1 for t in thresholds) == 3


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], max(row[j], row[j - 1], last + (x == y))
    return row[-1]


def test_common_subsequence():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 90))] for _ in range(2))
        masks = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | 1 << i
        bits = decontaminate.common(masks, len(a), b)
        for n in range(1, len(a) + 1):
            assert (bits & ((1 << n) - 1)).bit_count() == plain_lcs(a[:n], b)


def test_word_hashes_do_not_depend_on_slices(monkeypatch):
    rng = random.Random(7)
    text = " ".join("".join(rng.choice("abcé9") for _ in range(rng.randrange(1, 30))) + rng.choice(["", ".", ", "]) for _ in range(800))
    want = decontaminate.word_hashes(text)
    tokens = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    assert len(want) == len(tokens) and len(set(want.tolist())) == len(set(tokens))
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(decontaminate, "BYTES", size)
        assert decontaminate.word_hashes(text).tolist() == want.tolist()


def test_exact_and_paraphrased_passages_are_found(spark):
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in "bcdfghjklm" for b in ("ab", "eck", "ird", "oom", "und", "ill", "ant")]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [f"{text(rng.randrange(12, 40))}. {text(8)}." for _ in range(60)]

    def paraphrased(item):
        words = item.split()
        for _ in range(len(words) // 6):
            words[rng.randrange(len(words))] = rng.choice(["another", "thing"])
        del words[rng.randrange(len(words))]
        words.insert(rng.randrange(len(words)), "indeed")
        return " ".join(words)

    docs, want = [], set()
    for i in range(300):
        body = [text(rng.randrange(5, 400)), text(rng.randrange(0, 60))]
        if i % 3 == 0:
            k = rng.randrange(60)
            want.add((i, k))
            body.insert(1, items[k].upper() if i % 2 else paraphrased(items[k]))
        docs.append((i, " ".join(body)))
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    )
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want


def test_a_large_benchmark_loses_no_item(spark):
    rng = random.Random(14)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [vocabulary[int(3000 * rng.random() ** 2)] for _ in range(n)]
    items = [text(38) for _ in range(2400)]
    docs, planted = [], set()
    for i in range(60):
        k = rng.randrange(2400)
        copy = [w for j, w in enumerate(items[k]) if i % 2 or j % 5]  # every fifth word is missing, or none
        planted.add((i, k))
        docs.append(text(rng.randrange(90)) + copy + text(rng.randrange(90)))
    found = decontaminate.contaminated(
        spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(x) + ".") for i, x in enumerate(items)], "item_id long, text string"),
    )
    got = {(r.doc_id, r.item_id): r.covered for r in found.collect()}

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b):
                before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j], row[j + 1])
        return row[-1]

    want = {}
    for i, d in enumerate(docs):
        for k, x in enumerate(items):
            if sum(w in d for w in x) >= 0.5 * 38:
                covered = max(longest(x, d[at : at + 57]) / 38 for at in range(0, max(len(d) - 57, 0) + 16, 16))
                # One sentence is all answer, which takes 0.6 of it.
                if covered >= 0.6:
                    want[i, k] = covered
    assert planted <= want.keys() and got == pytest.approx(want)


def test_long_items_are_near_their_copies(spark):
    rng = random.Random(15)
    text = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    items = [text(n) for n in (20, 64, 65, 450, 600, 1000, 1000)]
    docs = spark.createDataFrame([(i, f"{text(50 + i)} {x} {text(50)}") for i, x in enumerate(items)], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    [block] = decontaminate.blocks_of(bench, docs)
    for r in docs.collect():
        assert r.doc_id in {block.ids[i] for i, _, _ in block.windows(decontaminate.word_hashes(r.text))}
    got = [(r.doc_id, r.item_id, r.covered) for r in decontaminate.contaminated(docs, bench).collect()]
    assert sorted(got) == [(i, i, 1.0) for i in range(len(items))]


def test_latent_space_keeps_the_passages(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(6, 40))
    dense = rng.normal(size=(50, 6)) @ base
    rows = spark.createDataFrame([(list(range(40)), [float(x) for x in r]) for r in dense], "buckets array<long>, weights array<double>")
    held, vectors = decontaminate.latent_space(rows, rank=6)
    assert held.tolist() == list(range(40))
    assert np.allclose(dense @ vectors @ vectors.T, dense, atol=1e-3)


def held_out(spark, sf_dir, name, label):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumnRenamed(label, "truth")
    return QUERIES[name](spark, sf_dir).join(labels, "doc_id").where("held_out").collect()


@pytest.fixture(scope="module")
def larger(sf_dir):
    return sf_dir.replace("sf0.001", "sf0.01")


def test_language_on_held_out_rows(spark, larger):
    truth = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    rows = QUERIES["op1_language"](spark, larger).join(truth, "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.truth for r in rows) / len(rows) > 0.98
    accepted = [r for r in rows if r.accepted]
    assert len(accepted) > 0.9 * len(rows) and sum(r.lang_pred == r.truth for r in accepted) >= 0.98 * len(accepted)


def test_quality_on_held_out_rows(spark, larger):
    rows = held_out(spark, larger, "op5_quality_cnn", "quality")
    assert sum(r.predicted == r.truth for r in rows) / len(rows) > 0.95


def test_toxicity_on_held_out_rows(spark, larger):
    rows = held_out(spark, larger, "op4_toxicity", "toxic")
    assert sum(r.predicted == r.truth for r in rows) / len(rows) > 0.95


def test_subsequence_kernel():
    rng = random.Random(10)

    def kernel(a, b):
        def features(w):
            out = {}
            for at in itertools.combinations(range(len(w)), 3):
                key = "".join(w[i] for i in at)
                out[key] = out.get(key, 0) + toxicity.DECAY ** (at[2] - at[0] - 2)
            return out

        fa, fb = features(a), features(b)
        dot = lambda x, y: sum(v * y.get(k, 0) for k, v in x.items())
        return dot(fa, fb) / np.sqrt(dot(fa, fa) * dot(fb, fb))

    words = ["".join(rng.choice("abc^$") for _ in range(rng.randrange(3, 10))) for _ in range(40)]
    got = toxicity.apply(words, toxicity.landmark_table(words[:8]))
    assert np.allclose(got, [[kernel(a, b) for b in words[:8]] for a in words], atol=1e-5)


def test_disguised_insults():
    rng = random.Random(11)
    plain = lambda: " ".join("".join(rng.choice(["ta", "ri", "no", "le", "su"]) for _ in range(rng.randrange(1, 4))) for _ in range(30))
    texts, labels = [], []
    for i in range(200):
        bad = rng.choice(["grumpkin", "blorfa", "skwyte"])
        texts.append(f"{plain()}. {plain()} {bad if i % 2 else ''} {plain()}.")
        labels.append(i % 2)
    model = toxicity.fit(texts, labels)
    for insult in ("grumpkin", "GRUMPKIN!", "grum-pkin", "grumpkxin", "g r u m p k i n", "b.l.o.r.f.a", "blorrfa", "skwytes"):
        assert model.scores([f"{plain()} {insult} {plain()}"])[0] > 0.5, insult
    assert (model.scores([plain() for _ in range(200)] + [None, ""]) < 0.5).all()


def test_network_reads_every_byte():
    rng = np.random.default_rng(12)
    chunks = [rng.integers(97, 123, (3, quality_cnn.SEEN)).astype(np.uint8) for _ in range(60)]
    for c in chunks[::2]:
        c[rng.integers(3), 100:104] = 42
    model = quality_cnn.fit(chunks, [i % 2 for i in range(60)])
    letters = "".join(chr(c) for c in rng.integers(97, 123, 200_000))
    texts = [letters, *[letters[:at] + "****" + letters[at + 4 :] for at in (0, 255, 256, 70_001, 199_996)]]
    for text in texts:
        raw = quality_cnn.padded(text)
        n = len(raw) - quality_cnn.WIDTH + 1
        plain = sum(model.tables[k][raw[k : n + k]] for k in range(quality_cnn.WIDTH))
        want = [np.maximum(plain[s : s + quality_cnn.CHUNK].max(axis=0) + model.bias, 0) for s in quality_cnn.chunk_starts(len(raw))]
        assert np.allclose(model.chunks(text), want, atol=1e-4) and 0 <= model.score(text) <= 1


def test_pipeline_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.collect()
    rules = {r.doc_id: r.ledger.failed for r in quality_rules.ledger(docs).collect()}
    rows = [r for r in rows if not rules[r.doc_id]]
    model = quality_model(spark, sf_dir)
    rows = [r for r in rows if model.score(r.text) >= 0.5]
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    component = {r.doc_id: r.doc_id for r in rows}
    for a, b in itertools.combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2 and component[a] != component[b]:
            old, new = max(component[a], component[b]), min(component[a], component[b])
            component = {k: new if v == old else v for k, v in component.items()}
    rows = [r for r in rows if component[r.doc_id] == r.doc_id]
    items = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r.text.lower()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]

    def leaks(text):
        flat = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())) + " "
        return any(f" {' '.join(i)} " in flat for i in items)

    rows = [r for r in rows if not leaks(r.text)]
    left = spark.createDataFrame(rows, docs.schema)
    want = {r.doc_id: r.copies for r in mixing.taken(left).collect() if r.copies}
    assert 0 < len(rows) < docs.count()

    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns, name
    mixed = corpus_pipeline.run(spark, sf_dir)
    got = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == want
    assert mixed.columns == [*docs.columns, "copy"]


def invented(rng, n):
    return ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 5))) for _ in range(n)]


def test_the_latent_search_finds_what_no_word_count_does(spark, monkeypatch):
    """Words in another order and the answer as it was: too little in order, but near in the latent space."""
    rng = random.Random(8)
    items = [invented(rng, 40) for _ in range(60)]
    text = lambda w: " ".join(w[:28]).capitalize() + ". " + " ".join(w[28:]).capitalize() + "."
    turned = lambda w: [*w[:6], *w[27:5:-1], *w[28:]]
    docs = [(i, " ".join(invented(rng, 60)) + " " + text(turned(w)) + " " + " ".join(invented(rng, 60))) for i, w in enumerate(items)]
    docs += [(100 + i, " ".join(invented(rng, 200))) for i in range(60)]
    bench = spark.createDataFrame([(i, text(w)) for i, w in enumerate(items)], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()}
    assert found <= {(i, i) for i in range(60)} and len(found) >= 54
    blocks = list(decontaminate.blocks_of(bench, df))
    monkeypatch.setattr(decontaminate.Items, "windows", lambda self, hashes: [])
    assert sum(len(h) for items in blocks for h in items.hits([t for _, t in docs])) <= 3


@pytest.mark.parametrize("n_items,n_words", [(40, 40), (2400, 40), (40, 300)])
def test_recall_of_the_latent_search_alone(spark, n_items, n_words):
    """Exact copies that the latent search finds without the word search beside it: at least nine tenths."""
    rng = random.Random(n_items)
    vocabulary = invented(rng, 3000)
    some = lambda n: [vocabulary[min(int(rng.paretovariate(0.7)) - 1, 2999)] for _ in range(n)]
    items = [" ".join(some(n_words)) for _ in range(n_items)]
    chosen = rng.sample(range(n_items), 40)
    texts = [" ".join(some(150)) + " " + items[i] + " " + " ".join(some(150)) for i in chosen]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    held = list(decontaminate.blocks_of(bench, docs))
    latent = sum(any(hit[0] == i for h in held for hit in h.confirmed(decontaminate.word_hashes(t), {})) for i, t in zip(chosen, texts, strict=True))
    both = sum(any(hit[0] == i for h in held for hit in h.hits([t])[0]) for i, t in zip(chosen, texts, strict=True))
    assert both == 40 and latent >= 36


def test_blocks_one_after_the_other_find_the_same(spark, monkeypatch):
    """Several blocks of a benchmark with text ids; repeated documents and a null one beside."""
    rng = random.Random(12)
    items = [" ".join(invented(rng, 30)) for _ in range(30)]
    texts = [None, "", *(" ".join(invented(rng, 50)) + " " + items[i] for i in (3, 3, 7, 20, 29))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*texts, texts[-1]])], "doc_id long, text string, HITS string")
    bench = spark.createDataFrame([(f"item {i}", t) for i, t in enumerate(items)], "item_id string, text string")
    one = sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect())
    assert one == [(2, "item 3"), (3, "item 3"), (4, "item 7"), (5, "item 20"), (6, "item 29"), (7, "item 29")]
    monkeypatch.setattr(decontaminate, "ITEMS", 8)
    marked = decontaminate.mark(docs, bench)
    assert marked.columns == ["doc_id", "text", "hits"] and marked.count() == len(texts) + 1
    assert sorted((r.doc_id, h.item_id) for r in marked.collect() for h in r.hits) == one
