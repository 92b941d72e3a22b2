"""Phrase collocations and their index against plain counting."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.llm import collocations
from oreflow.llm.phrase_index import PhraseIndex

SCHEMA = "doc_id long, lang string, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    counts, total = {}, Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for m in range(1, 5):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    found = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i : i + m]] = max(longer[p[i : i + m]], a)
        best = []
        for p, a in candidates.items():
            if longer[p] and 100 * longer[p] >= 80 * a:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            found.add((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return found


def test_index():
    """Every phrase of up to four words, extended to either side, has its count."""
    random = np.random.default_rng(5)
    text = np.append(random.integers(0, 6, 3000), 0)
    index = PhraseIndex(text, 6, 4)
    for sides in ([True], [False], [True, False], [False, True], [False, True, False], [True, True, True], [True, False, True]):
        found = index.words()
        for left in sides:
            found = index.extend(found, left)
        m = len(sides) + 1
        expected = Counter(tuple(text[i : i + m].tolist()) for i in range(len(text) - m + 1) if text[i : i + m].all())
        assert {tuple(w): n for w, n in zip(found.words.tolist(), found.count.tolist(), strict=True)} == expected


@pytest.mark.parametrize(("shard", "bucket"), [(1 << 21, 1 << 22), (300, 500)])
def test_brute_force(spark, monkeypatch, shard, bucket):
    monkeypatch.setattr(collocations, "SHARD_WORDS", shard)
    monkeypatch.setattr(collocations, "BUCKET_PAIRS", bucket)
    random = np.random.default_rng(1)
    vocabulary = ["The", "of", "ÉTÉ", "a", "new", "york", "City", "x-1", "中文"]
    rows = [
        (i, ["en", "fr", None, "und"][i % 4], "".join(vocabulary[w] + [" ", "\t", "  ", ". ", "\n", " "][w % 6] for w in random.zipf(1.5, 60) % 9))
        for i in range(400)
    ]
    rows += [(1, "en", None), (2, "de", ""), (3, "de", " .,;\n"), (None, "en", "new york city " * 3000), (5, "en", "new york"), (5, "en", "new york")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("word", "words", "shard", "hash", "id", "n"):
        frame = frame.withColumn(name, F.lit("x"))
    got = {tuple(row) for row in collocations.digest(frame, least=30, top=40).collect()}
    assert got == brute(rows, 30, 40)


def test_given_documents(spark, sample):
    rows = [(0, row["lang"], row["text"]) for row in sample.select("lang", "text").collect()]
    assert {tuple(row) for row in collocations.digest(sample, least=5).collect()} == brute(rows, 5, 2000)


def test_hashes_that_meet(spark, monkeypatch):
    """A seed under which two words share a hash is not used."""
    real = F.xxhash64

    def poor(seed, *columns):
        return F.when(seed == 0, F.lit(7).cast("long")).otherwise(real(seed, *columns))

    monkeypatch.setattr(collocations.F, "xxhash64", poor)
    frame = spark.createDataFrame([(1, "en", "a b a b a b")], SCHEMA)
    assert collocations.dictionary(collocations.tokens(frame))[1] == 1


def test_nothing(spark):
    assert collocations.digest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations.digest(spark.createDataFrame([(1, "en", "a b")], SCHEMA)).count() == 0
