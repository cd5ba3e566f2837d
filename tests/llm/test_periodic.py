"""Periodic runs against plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerglass.llm import periodic
from peerglass.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain_runs(words):
    """(start, length, period) by trying all periods at all places."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        start = 0
        for i in range(len(words) - q + 1):
            if i == len(words) - q or words[i] != words[i + q]:
                length = i - start + q
                if i > start and length >= max(6, 4 * q):
                    found.setdefault((start, length), q)
                start = i + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def planted(doc, words):
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc, text):
    words = planted(doc, split(text)) if doc is not None else split(text)
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))


def test_query_agrees_with_plain_python(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = QUERIES["op12_periodic"](spark, FOLDER).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(expected(*d) for d in docs)
    assert sum(r.n_runs > 0 for r in got) > 5


def made_words(rng):
    """Words with runs inside runs, of few and of many different words."""
    vocab = [f"w{i}" for i in range(rng.choice([2, 3, 50]))]
    words = []
    while len(words) < rng.choice([40, 300, 2500]):
        part = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 5, 9, 17, 33, 70, 200]))]
        if rng.random() < 0.4:
            part = part[:3] + part[3:4] * rng.randint(1, 30) + part[4:]
        times = rng.choice([1, 1, 3, 4, 5, 7])
        words += (part * times)[:len(part) * times - rng.randrange(len(part))]
    return words


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_made_words(seed):
    rng = random.Random(seed)
    texts = [made_words(rng) for _ in range(4)]
    row, begins = [], []
    names = {}
    for n, words in enumerate(texts):
        begins.append(len(row))
        row += [names.setdefault(w, len(names)) for w in words] + [-1 - n]
    found = periodic.find(np.array(row), max(map(len, texts)))
    want = [(begin + s, length, q) for begin, words in zip(begins, texts) for s, length, q in plain_runs(words)]
    assert list(map(tuple, found.tolist())) == sorted(want, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("piece", [1, 400, 1 << 19])
def test_awkward_rows(spark, monkeypatch, piece):
    monkeypatch.setattr(periodic, "PIECE", piece)
    rng = random.Random(2)
    long = [f"x{rng.randrange(10**6)}" for _ in range(5000)]
    texts = [None, "", " \n\x0b", "one", "a " * 5, "a " * 6, "a\ta\na\x0ca\ra\x0ba", "a b " * 4, "a b c " * 3, "a\x1ca " * 7, "é 😀 " * 6,
             "the same " * 30_000, " ".join(long * 5), " ".join(long[:100] + long[:30] * 4 + long), "x " * 7 + "y " * 7 + "x y " * 5]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, texts[7]), (4, texts[7]), (None, texts[7])]
    made = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name in ("runs", "collapsed", "best", "start", "period"):
        made = made.withColumn(name, F.lit("clash"))
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.find_runs(made).collect()]
    want = []
    for doc, text in rows:
        words = split(text)
        runs = [(0, len(words), 2)] if len(words) == 60_000 else [(0, 25_000, 5000)] if len(words) == 25_000 else plain_runs(words)
        want.append((doc, runs, collapsed(words, runs)))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert periodic.find_runs(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_the_first_of_equally_repeated_runs(spark):
    rows = [([(0, 8, 2), (3, 12, 3), (5, 4, 1)],), ([(0, 9, 2), (9, 14, 3)],), ([],)]
    made = spark.createDataFrame(rows, f"runs {periodic.RUNS}")
    got = [r.best and tuple(r.best) for r in made.select(periodic.most_repeated(F.col("runs")).alias("best")).collect()]
    assert got == [(0, 8, 2), (9, 14, 3), None]
