"""Runs of words against brute force: tiles of several sizes, planted periods, odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.llm import periodic
from cartwise.llm import text as tx


def brute_runs(words):
    """All runs (start, length, period), one lag after the other."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(12, 2 * q):
                part = words[i : i + length]
                if not any(part[r:] == part[: length - r] for r in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_words(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = 0 if doc_id is None else zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def brute_report(doc_id, text):
    words = brute_words(doc_id, text)
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    four = (None,) * 4 if best is None else (best[0], best[1], best[2], 1000 * best[1] // best[2])
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *four, *sha)


def solved(words, tile):
    codes = tx.mix(np.array(words, np.uint64) * np.uint64(7919) + np.uint64(3))
    found = []
    for low, core, core_end, first, last in periodic.tiles(len(words), tile):
        part = codes[low : core_end + 2 * periodic.margin(last)]
        period, start, end = periodic.solve(part, core - low, core_end - low, first, last)
        found.append((period, start + low, end + low))
    period, start, end = periodic.merged(*(np.concatenate(c) for c in zip(*found)))
    runs = zip(start.tolist(), (end - start + period).tolist(), period.tolist())
    return sorted(runs, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("tile", [16, 64, 1 << 14])
def test_tiles_find_what_brute_force_finds(tile):
    draw = random.Random(5)
    for _ in range(200):
        n, kinds = draw.randint(12, 200), draw.choice([1, 2, 2, 3, 5])
        words = [draw.randrange(kinds) for _ in range(n)]
        if draw.random() < 0.6:
            a = draw.randrange(n)
            p = draw.randint(1, max(1, (n - a) // 2))
            words[a:] = [words[a + (i - a) % p] for i in range(a, n)]
            if draw.random() < 0.5:
                words[draw.randrange(n)] = 9
        assert solved(words, tile) == brute_runs(words)


@pytest.mark.parametrize("tile", [32, 1 << 14])
def test_words_rich_in_runs(tile):
    thue = [bin(i).count("1") & 1 for i in range(600)]
    short, fibonacci = [0], [0, 1]
    while len(fibonacci) < 500:
        short, fibonacci = fibonacci, fibonacci + short
    for words in (thue, fibonacci, [0] * 500, [i % 150 for i in range(500)]):
        assert solved(words, tile) == brute_runs(words)


def test_one_long_document_of_one_word_is_one_run():
    assert solved([0] * 70_000, 1 << 12) == [(0, 70_000, 1)]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(7)
    out = [(None, "a b " * 40), (None, None), (1, ""), (2, None), (3, " \t\n "), (4, "word"), (5, "x " * 2000 + "end")]
    for doc_id in range(10, 90):
        words = [draw.choice(["la", "le", "lü", "du", "da"]) for _ in range(draw.randint(0, 120))]
        if doc_id % 2 and len(words) > 30:
            at, q = draw.randrange(len(words) - 20), draw.randint(1, 9)
            words[at:] = [words[at + (i - at) % q] for i in range(at, len(words) - 3)] + words[-3:]
        out.append((doc_id, draw.choice([" ", "\n", " \t"]).join(words)))
    return out + [out[0], out[10], out[10]]


@pytest.mark.parametrize("tile", [32, periodic.TILE])
def test_report_equals_brute_force(spark, texts, tile):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for name in ("k1", "k2", "h", "runs", "period", "start", "length", "best", "lang"):
        docs = docs.withColumn(name, F.lit("other"))
    out = [tuple(r) for r in periodic.report(docs, tile).collect()]
    assert sorted(out, key=str) == sorted((brute_report(*r) for r in texts), key=str)
    assert sum(r[1] for r in out) > 20
    assert periodic.report(docs.limit(0), tile).count() == 0
