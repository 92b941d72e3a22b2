"""Byte-level BPE and packing against the libraries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from oreflow.llm import byte_bpe, packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
MIXED = ["a", "the", "in", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "​", "é", "ΑΣ", "ß", "²", "½", "中文", "😀", "́", "'s", "'ll", "'", "1", "23", "_", "!!", ".", ",", "\r\n", "\x00", "İ", "×", "<|endoftext|>", "THE", "x9"]


@pytest.fixture(scope="module")
def theirs():
    with open(RANKS, "rb") as file:
        ranks = byte_bpe.read_ranks(file.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def merger():
    with open(RANKS, "rb") as file:
        return byte_bpe.Merger(byte_bpe.read_ranks(file.read()))


def test_random_texts(theirs, merger):
    rng, splitter = random.Random(1), byte_bpe.Splitter(public_tokenizers.PATTERN)
    texts = ["".join(rng.choice(MIXED) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["a" * 700, " " * 300 + "x", "".join(rng.choice("abcdeth") for _ in range(5000))]
    for text in texts:
        ids = b"".join(x for pieces in splitter.lists(text) for x in merger.encode([p.encode() for p in pieces]))
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(text)


def test_long_text_in_parts(monkeypatch):
    monkeypatch.setattr(byte_bpe, "TOGETHER", 50)
    monkeypatch.setattr(byte_bpe, "PIECES", 7)
    splitter = byte_bpe.Splitter(public_tokenizers.PATTERN)
    text = "Some words, 123 numbers and  spaces\n\n" * 9
    lists = list(splitter.lists(text))
    assert len(lists) > 3 and sum(lists, []) == splitter.whole.findall(text)


def test_bpe_digest(clashing, odd, nothing, theirs):
    rows = byte_bpe.digest(clashing, RANKS, public_tokenizers.PATTERN).collect()
    expected = Counter()
    for row in odd.collect():
        text = row["text"] or ""
        ids = theirs.encode_ordinary(text)
        expected[row["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(tuple(row) for row in rows) == expected
    assert byte_bpe.digest(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_words_one_by_one():
    """Tokenising word by word gives the ids of the whole text."""
    with open(WORDS, encoding="utf-8") as file:
        mine = packing.WordTokenizer(file.read())
    whole = Tokenizer.from_file(WORDS)
    whole.encode_special_tokens = True
    rng = random.Random(1)
    texts = ["".join(rng.choice(MIXED) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    for text, ids in zip(texts, mine.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def check_pieces(rows, lengths, window):
    """Every token of every document in one piece, sequences without gaps; returns the padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row["row"]].append((row["start"], row["length"]))
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    assert len(pieces) == len(lengths)
    for row, parts in pieces.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == lengths[row]
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


@pytest.mark.parametrize(("window", "top", "n"), [(64, 200, 800), (64, 63, 37), (4096, 9000, 300), (16, 16, 1)])
def test_pack(spark, monkeypatch, window, top, n):
    monkeypatch.setattr(packing, "NUMBERED", 5)
    rng = random.Random(n)
    lengths = {k: rng.choice([rng.randint(1, top), 7, window]) for k in range(n)}
    tokens = spark.createDataFrame([(k, k, x) for k, x in lengths.items()], "row long, doc_id long, n_tokens long").repartition(3)
    assert check_pieces(packing.pack(tokens, window).collect(), lengths, window) == 0


def test_least_squares():
    """Lengths that pair up exactly are all matched by combinations."""
    histogram = {3000: 50, 1096: 50, 2048: 20, 1000: 33, 1548: 66}
    combos = packing.combinations(histogram, 4096)
    assert all(sum(c) == 4096 for c in combos)
    repeats = packing.solve_repeats(histogram, combos, 4096)
    used = Counter()
    for combo, k in zip(combos, repeats, strict=True):
        for part in combo:
            used[part] += k
    assert all(used[x] <= histogram[x] for x in used)
    assert used[3000] == 50 and used[1096] == 50 and sum(used.values()) >= 0.95 * sum(histogram.values())
    assert packing.solve_repeats({}, [], 4096) == []


def test_packing_digest(odd, clashing, nothing):
    whole = Tokenizer.from_file(WORDS)
    whole.encode_special_tokens = True
    tokens = packing.tokenise(clashing, WORDS)
    pieces = packing.pack(tokens)
    lengths = {row["row"]: row["n_tokens"] for row in tokens.select("row", "n_tokens").collect()}
    assert len(lengths) == odd.count()
    assert check_pieces(pieces.collect(), lengths, 4096) == 0
    ids = {row["row"]: np.frombuffer(row["ids"], "<u2").astype("<u4").tobytes() for row in tokens.collect()}
    expected = sorted(np.array([*whole.encode(row["text"] or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for row in odd.collect())
    assert sorted(ids.values()) == expected
    for row in packing.with_checksums(pieces, tokens).collect():
        assert row["ids_crc32"] == zlib.crc32(ids[row["row"]][4 * row["start"] : 4 * (row["start"] + row["length"])])
    for row in packing.with_ids(pieces, tokens).collect():
        assert row["ids"] == ids[row["row"]][4 * row["start"] : 4 * (row["start"] + row["length"])]
    assert packing.digest(nothing, WORDS).count() == 0


def test_words_are_remembered_within_bounds(monkeypatch):
    """However many words a process sees, it keeps few, and ids stay those of the library."""
    monkeypatch.setattr(packing, "REMEMBERED", 50_000)
    with open(WORDS, encoding="utf-8") as file:
        tokenizer = packing.WordTokenizer(file.read())
    whole = Tokenizer.from_file(WORDS)
    for part in range(20):
        text = " ".join(f"word{part}x{i}, Über{i} 中文{part}" for i in range(200))
        (ids,) = tokenizer.encode([text])
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
        assert sum(len(w) + len(x) + packing.ENTRY for w, x in tokenizer.known.items()) < 50_000 + 2000 * 200


def test_words_are_learnt_without_capitals_and_closing_marks():
    with open(WORDS, encoding="utf-8") as file:
        tokenizer = packing.WordTokenizer(file.read())
    whole = Tokenizer.from_file(WORDS)
    whole.encode_special_tokens = True
    texts = ["Été été, ÉTÉ. (été) Été!? été;\n", "a,b, a,.c,. 'S's, 1,2. ?, ß. x-, ...", "It's, l'été|", "<|EndOfText|>, end.\x0b中,", "ÀÖØ÷×, ý. þÿ#", "Ünï¿, ñ\x1f. ½, a²."]
    for text, ids in zip(texts, tokenizer.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert {word for word in tokenizer.known if "t" in word and word.isalpha()} == {"été"}
    assert tokenizer.letters is not None
