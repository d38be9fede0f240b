"""Periodic runs against every period of every text."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tickloom.llm import periodic


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(12, 2 * q):
                found.setdefault((i, length), q)
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def random_words(rng):
    n, letters = rng.randrange(0, 90), rng.choice([1, 2, 3, 5])
    words = [bytes([97 + rng.randrange(letters)]) for _ in range(n)]
    if n and rng.random() < 0.6:
        p = rng.randrange(1, n + 1)
        words = words[:p] * rng.randrange(1, 7) + words[p:]
    return words


def test_runs_against_every_period():
    rng = random.Random(7)
    for _ in range(400):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 6))]
        owner, rows = periodic.find_runs(texts)
        for i, words in enumerate(texts):
            assert [tuple(r) for r in rows[owner == i].tolist()] == [(s, n, q) for s, n, q in plain_runs(words)]


def test_many_and_overlapping_runs():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 1500:
        a, b = b, b + a
    _, rows = periodic.find_runs([b])
    assert [tuple(r) for r in rows.tolist()] == plain_runs(b) and len(rows) > 100


def plain_document(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return n, runs, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


@pytest.mark.parametrize("chunk", [50, 1 << 21])
def test_documents(spark, monkeypatch, chunk):
    monkeypatch.setattr(periodic, "CHUNK_WORDS", chunk)
    rng = random.Random(3)
    rows = [(i, "  ".join(w.decode() for w in random_words(rng)), "x") for i in range(150)]
    rows += [(None, "a b " * 40, None), (None, "a b " * 40, None), (150, None, "x"), (151, "", "x"), (152, " \x0b\n", "y")]
    rows += [(153, "one two three " * 1000, "y"), (154, "é\xa0é " * 20, "y"), (14, "twice the id", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, periodic string")
    shaped = periodic.repeated_tails(docs).withColumn("PERIODIC", F.lit(1))
    found = periodic.collapse(shaped)
    assert found.columns == ["doc_id", "text", "periodic"]
    got = sorted(
        (str(r.doc_id), r.periodic.n_words, [tuple(x) for x in r.periodic.runs], r.periodic.collapsed) for r in found.collect()
    )
    assert got == sorted((str(d), *plain_document(d, t)) for d, t, _ in rows)
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _, _ in rows) > 5
    assert periodic.digests(found).count() == len(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.digests(periodic.collapse(periodic.repeated_tails(docs))).count() == 0
