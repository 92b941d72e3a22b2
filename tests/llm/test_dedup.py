"""Byte strings, lines and near-duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.llm import chosen_path, line_dedup, suffix_dedup
from oreflow.llm.components import connected_components

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# Repeated byte strings.


def repeats(docs, length):
    seen, out = set(), {}
    for i in sorted(docs):
        raw = docs[i].encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            window = raw[at : at + length]
            if window in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(window)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = (len(raw), sum(gone), spans, sha(bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return out


def by_id(frame):
    return {row[0]: tuple(row)[1:] for row in frame.collect()}


@pytest.mark.parametrize("bucket", [150_000, 60])
def test_byte_strings(spark, monkeypatch, bucket):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    rng = random.Random(5)
    parts = ["".join(rng.choice("abcde ") for _ in range(400)) for _ in range(4)]
    docs = {}
    for i in range(80):
        text = ""
        for _ in range(rng.randint(0, 5)):
            part, at = rng.choice(parts), rng.randint(0, 300)
            text += part[at : at + rng.randint(50, 300)] + rng.choice(["", "x" * rng.randint(1, 260), "é" * 30, "ab" * rng.randint(1, 150)])
        docs[i] = text
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    assert by_id(suffix_dedup.digest(frame)) == repeats(docs, 100)


def test_byte_strings_of_documents(sample, texts):
    assert by_id(suffix_dedup.digest(sample)) == repeats(texts, 100)


def test_byte_strings_odd(odd, clashing, nothing):
    rows = suffix_dedup.digest(clashing).collect()
    assert len(rows) == odd.count()
    assert suffix_dedup.digest(nothing).count() == 0
    long = next(row for row in rows if row["doc_id"] == 5)
    assert long["n_bytes"] - long["n_removed"] < 200 and long["n_spans"] == 1
    # Rows equal in id and text are one document.
    assert all(row["n_removed"] == 0 for row in rows if row["doc_id"] == 1)


def test_multikey_quicksort():
    rng = np.random.default_rng(1)
    strings = rng.integers(0, 3, (5000, 20), dtype=np.uint8)
    order = suffix_dedup.multikey_quicksort(strings)
    ranked = [bytes(x) for x in strings[order]]
    assert ranked == sorted(ranked)
    common = suffix_dedup.common_prefixes(strings, order)
    for k in (1, 7, 4999):
        a, b = ranked[k - 1], ranked[k]
        assert common[k] == next((i for i in range(20) if a[i] != b[i]), 20)


# Lines.


def lines(docs, least):
    holders = Counter()
    for text in docs.values():
        holders.update({line.strip(SPACES).translate(LOWER) for line in text.split("\n")})
    out = {}
    for i, text in docs.items():
        all_lines = text.split("\n")
        kept = [x for x in all_lines if not (x.strip(SPACES) and holders[x.strip(SPACES).translate(LOWER)] >= least)]
        out[i] = (len(all_lines), len(all_lines) - len(kept), sha("\n".join(kept)))
    return out


@pytest.mark.parametrize(("batches", "fan_in", "least"), [(4, 4, 10), (7, 2, 3)])
def test_lines(sample, texts, batches, fan_in, least):
    plain = line_dedup.remove_frequent_lines(sample.select("doc_id", "text"), least, batches, fan_in)
    got = by_id(plain.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)))
    assert got == lines(texts, least)


def test_lines_odd(odd, clashing, nothing):
    assert line_dedup.digest(nothing).count() == 0
    done = line_dedup.remove_frequent_lines(clashing, threshold=3)
    # The input's own columns keep their values; the counts get free names.
    assert done.columns == [*clashing.columns, "_n_lines", "_n_dropped"]
    rows = done.collect()
    assert len(rows) == odd.count()
    # Held by documents 1, 6 and one without an id; row 1 is there twice but one document.
    first = [row for row in rows if row["doc_id"] == 1 and "Alpha" in row["text"]]
    assert [row["text"] for row in first] == ["Alpha beta gamma.\n\nend"] * 2
    assert [row["_n_dropped"] for row in first] == [2, 2]
    assert [row["n_lines"] for row in first] == ["en", "en"]
    assert {row["_n_lines"] for row in rows if row["doc_id"] in (2, 3)} == {1}
    assert all(row["text"] is None for row in rows if row["doc_id"] == 2)
    assert line_dedup.remove_frequent_lines(odd, threshold=4).where("n_dropped > 0").count() == 0


# Near-duplicates.


def shingles(text, words):
    found = [w for w in "".join(c if c not in SPACES else " " for c in text.translate(LOWER)).split(" ") if w]
    if not found:
        return frozenset()
    n = min(words, len(found))
    return frozenset(tuple(found[k : k + n]) for k in range(len(found) - n + 1))


def near(docs, words):
    sets = {i: shingles(text, words) for i, text in docs.items()}
    root = {i: i for i in docs}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= 80 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 80 * (len(x) + len(y) - both):
                    low, high = sorted((top(a), top(b)))
                    root[high] = low
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def test_near_documents(sample, texts):
    assert by_id(chosen_path.digest(sample)) == near(texts, 2)


def test_near_many_copies(spark, monkeypatch):
    """A large group of near copies, chains whose ends are not alike, and links just at the threshold."""
    monkeypatch.setattr(chosen_path, "SMALL", 4)
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(2000)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    docs = {}
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        docs[1000 - i] = " ".join(words)
    chain = [rng.choice(vocabulary) for _ in range(100)]
    for i in range(12):
        docs[i] = " ".join(chain)
        for _ in range(3):
            chain[rng.randrange(len(chain))] = rng.choice(vocabulary)
    docs[500] = " ".join(f"t{k}" for k in range(10))
    docs[501] = " ".join(f"t{k}" for k in range(9))
    docs[502] = "single"
    docs[503] = "SINGLE "
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    assert by_id(chosen_path.digest(frame)) == near(docs, 2)


def test_near_unlinked_group(spark, monkeypatch):
    """Many near copies around the threshold: few have a link to the leaf's first item, later rounds find the rest."""
    rng = random.Random(6)
    base = [f"w{k}" for k in range(150)]
    docs = {}
    for i in range(700):
        words = list(base)
        for at in rng.sample(range(150), rng.choice((4, 5, 6, 7, 9))):
            words[at] = f"n{i}x{at}"
        docs[i] = " ".join(words)
    compared, real = [], chosen_path.materialise

    def counted(frame, name):
        out = real(frame, name)
        if name == "pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(chosen_path, "materialise", counted)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    want = near(docs, 2)
    assert 2 <= len({row[1] for row in want.values()}) < 700
    assert by_id(chosen_path.digest(frame)) == want
    # All pairs of the group would be 245,000.
    assert len(compared) > 3 and sum(compared) < 20_000


def test_near_odd(odd, clashing, nothing):
    assert chosen_path.digest(nothing).count() == 0
    rows = chosen_path.digest(odd).collect()
    assert len(rows) == odd.count()
    for row in rows:
        if row["doc_id"] in (2, 3, 4):
            assert (row["n_shingles"], row["component_id"], row["kept"]) == (0, row["doc_id"], True)
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["kept"]
    kept = chosen_path.deduplicate(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == odd.count()


def test_components(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(0, 60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)]
    rng.shuffle(links)
    root = defaultdict(lambda: None)
    for a, b in links:
        root[a], root[b] = root[a] if root[a] is not None else a, root[b] if root[b] is not None else b
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= (root[a], root[b]) != (low, low)
            root[a] = root[b] = low
    got = {row["node"]: row["root"] for row in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    lone = {a for a, b in links if a == b} - set(got)
    assert got == {k: v for k, v in root.items() if k not in lone}
