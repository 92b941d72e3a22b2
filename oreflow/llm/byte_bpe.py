"""Byte-level BPE encoding and decoding.

A pattern splits each text into pieces. Within a piece the live symbols form a linked list over
its byte positions, and a segment tree over the positions holds, at each leaf, the rank of the
pair that starts there, and at the root the lowest rank, leftmost first. A merge takes the root's
pair and updates three leaves, each along one path to the root. Pieces of like length go through
the same steps together, as rows of one table.

A null text is empty. An empty text has no ids. Special tokens are not recognised: their strings
are ordinary text. Every row is encoded by itself; repeated rows and null ids pass through. An
empty table gives an empty result. Long texts are split into pieces bit by bit.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import bounded_batches, documents_only

# Distinct pieces that a task remembers before it starts afresh, and the longest piece that it remembers.
REMEMBERED, SHORT = 500_000, 64
# Characters of texts that are encoded together, and pieces of a long text.
TOGETHER, PIECES = 1 << 20, 200_000
NONE = np.iinfo(np.int64).max
# White space and visible characters of ASCII, and the letters of Latin-1.
LATIN_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
NOT_LATIN = re.compile(f"[^\t-\r -~{LATIN_LETTERS}]")


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks of a file whose lines hold a token in base 64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line)}


class Splitter:
    """Splits texts by a pattern; texts of Latin letters alone go through a plainer form of the same pattern."""

    def __init__(self, pattern: str):
        self.whole = regex.compile(pattern)
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{LATIN_LETTERS}0-9]")
        plain = plain.replace(r"\p{L}", f"[{LATIN_LETTERS}]").replace(r"\p{N}", "[0-9]")
        self.latin = None if r"\p" in plain else re.compile(plain)

    def lists(self, text: str) -> Iterator[list[str]]:
        pattern = self.latin if self.latin and not NOT_LATIN.search(text) else self.whole
        if len(text) <= TOGETHER:
            yield pattern.findall(text)
            return
        some = []
        for match in pattern.finditer(text):
            some.append(match.group())
            if len(some) == PIECES:
                yield some
                some = []
        yield some


class Merger:
    """Encodes pieces by ranks of byte strings."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {
            (ranks[token[:i]] << 32) | ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        # An open-addressed table of the pairs, so that many can be looked up at once.
        self.bits = max(4, (3 * len(pairs)).bit_length())
        self.pair_keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.pair_ranks = np.full(1 << self.bits, NONE, dtype=np.int64)
        self.pairs = pairs
        left, values = np.array(list(pairs), dtype=np.int64), np.array(list(pairs.values()), dtype=np.int64)
        slots = self._slot(left)
        while len(left):
            free = self.pair_keys[slots] == -1
            _, first = np.unique(np.where(free, slots, -1 - np.arange(len(slots))), return_index=True)
            taken = first[free[first]]
            self.pair_keys[slots[taken]], self.pair_ranks[slots[taken]] = left[taken], values[taken]
            rest = np.ones(len(left), dtype=bool)
            rest[taken] = False
            left, values, slots = left[rest], values[rest], (slots[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        slots = self._slot(keys)
        there = self.pair_keys[slots]
        found = np.where(there == keys, self.pair_ranks[slots], NONE)
        open_ = np.flatnonzero((there != keys) & (there != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            there = self.pair_keys[slots[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self.pair_ranks[slots[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return found

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every piece, as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = [b""] * len(pieces)
        lengths = np.array([len(piece) for piece in pieces], dtype=np.int64)
        for number in np.flatnonzero(lengths > SHORT).tolist():
            out[number] = self._one(pieces[number])
        width = 2
        while width <= SHORT:
            alike = np.flatnonzero((lengths <= width) & (lengths > (width >> 1 if width > 2 else 0)))
            for begin in range(0, len(alike), 1 << 14):
                part = alike[begin : begin + (1 << 14)]
                for number, ids in zip(part.tolist(), self._many([pieces[i] for i in part.tolist()], lengths[part], width), strict=True):
                    out[number] = ids
            width <<= 1
        return out

    def _many(self, pieces: list[bytes], lengths: np.ndarray, width: int) -> list[bytes]:
        n, place = len(pieces), np.arange(width)
        raw = np.frombuffer(b"".join(piece.ljust(width, b"\0") for piece in pieces), dtype=np.uint8).reshape(n, width)
        # Position ``width`` stands for the end of the piece on either side.
        token = np.zeros((n, width + 1), dtype=np.int64)
        token[:, :width] = self.byte_ids[raw]
        following = np.minimum(np.arange(1, width + 2), width) + np.zeros((n, 1), dtype=np.int64)
        following[:, :width] = np.where(place + 1 < lengths[:, None], place + 1, width)
        before = np.arange(-1, width) + np.zeros((n, 1), dtype=np.int64)
        before[:, 0] = width
        live = np.zeros((n, width + 1), dtype=bool)
        live[:, :width] = place < lengths[:, None]

        tree = np.full((n, 2 * width), NONE, dtype=np.int64)
        row, at = np.nonzero(place + 1 < lengths[:, None])
        rank = self.pair_rank(token[row, at], token[row, at + 1])
        tree[row, width + at] = np.where(rank == NONE, NONE, rank * width + at)
        step = width
        while step > 1:
            tree[:, step >> 1 : step] = np.minimum(tree[:, step : 2 * step : 2], tree[:, step + 1 : 2 * step : 2])
            step >>= 1

        row = np.flatnonzero(tree[:, 1] != NONE)
        while len(row):
            best = tree[row, 1]
            at, rank = best % width, best // width
            right = following[row, at]
            after = following[row, right]
            prior = before[row, at]
            token[row, at] = rank
            live[row, right] = False
            following[row, at] = after
            before[row, after] = at
            for left, pair in (
                (right, None),
                (at, (rank, after)),
                (prior, (token[row, prior], at)),
            ):
                if pair is None:
                    value, rows, leaf = np.full(len(row), NONE), row, left
                elif left is at:
                    joined = self.pair_rank(rank, token[row, after])
                    joined[after == width] = NONE
                    value, rows, leaf = np.where(joined == NONE, NONE, np.minimum(joined, 1 << 40) * width + at), row, at
                else:
                    there = prior != width
                    rows, leaf = row[there], prior[there]
                    joined = self.pair_rank(token[rows, leaf], rank[there])
                    value = np.where(joined == NONE, NONE, np.minimum(joined, 1 << 40) * width + leaf)
                node = leaf + width
                tree[rows, node] = value
                while len(rows) and node[0] > 1:
                    value = np.minimum(value, tree[rows, node ^ 1])
                    node = node >> 1
                    tree[rows, node] = value
            row = row[tree[row, 1] != NONE]
        ids = token[live].astype("<u4").tobytes()
        ends = np.concatenate([[0], np.cumsum(live.sum(axis=1))]).tolist()
        return [ids[4 * a : 4 * b] for a, b in zip(ends, ends[1:], strict=False)]

    def _one(self, piece: bytes) -> bytes:
        """The same for one long piece, on plain lists."""
        n, pairs = len(piece), self.pairs
        width = 1 << (n - 1).bit_length()
        token = [int(x) for x in self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]]
        following, before = [*range(1, n), -1], [-1, *range(n - 1)]
        tree = [NONE] * (2 * width)

        def value(left: int, right: int) -> int:
            rank = pairs.get((token[left] << 32) | token[right]) if left >= 0 and right >= 0 else None
            return NONE if rank is None else rank * width + left

        tree[width : width + n - 1] = [value(i, i + 1) for i in range(n - 1)]
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(leaf: int, best: int) -> None:
            node = leaf + width
            tree[node] = best
            while node > 1:
                best = min(best, tree[node ^ 1])
                node >>= 1
                if tree[node] == best:
                    break
                tree[node] = best

        while tree[1] != NONE:
            rank, at = divmod(tree[1], width)
            right = following[at]
            after = following[right]
            token[at], token[right], following[at] = rank, -1, after
            if after >= 0:
                before[after] = at
            put(right, NONE)
            put(at, value(at, after))
            if before[at] >= 0:
                put(before[at], value(before[at], at))
        return np.array([t for t in token if t >= 0], dtype="<u4").tobytes()


def _encoder(pattern: str, lines):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, merger, known = Splitter(pattern), Merger(read_ranks(lines.value)), {}

        def ids(lists: list[list[str]]) -> list[bytes]:
            """The ids of each list; pieces that are new in any of them go through the merges together."""
            if len(known) > REMEMBERED:
                known.clear()
            new: set[str] = set()
            for pieces in lists:
                if None in (found := list(map(known.get, pieces))):
                    new.update([piece for piece, there in zip(pieces, found, strict=True) if there is None])
            known.update(zip(new, merger.encode([piece.encode() for piece in new]), strict=True))
            joined = [b"".join([known[piece] for piece in pieces]) for pieces in lists]
            for piece in new:
                if len(piece) > SHORT:
                    del known[piece]
            return joined

        def rows(numbers: list, encoded: list[bytes]) -> pa.RecordBatch:
            ends = np.cumsum([0, *(len(x) // 4 for x in encoded)])
            values = pa.array(np.frombuffer(b"".join(encoded), dtype="<u4").astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), lists], ["doc_id", "ids"])

        for batch in batches:
            numbers, lists, size = [], [], 0
            for number, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                numbers.append(number)
                if len(text) > TOGETHER:
                    lists.append([])
                    yield rows(numbers, [*ids(lists[:-1]), b"".join(ids([pieces])[0] for pieces in splitter.lists(text))])
                    numbers, lists, size = [], [], 0
                    continue
                lists += splitter.lists(text)
                size += len(text)
                if size > TOGETHER:
                    yield rows(numbers, ids(lists))
                    numbers, lists, size = [], [], 0
            yield rows(numbers, ids(lists))

    return encode


def _decoder(lines):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {rank: token for token, rank in read_ranks(lines.value).items()}
        for batch in batches:
            texts = [b"".join([table[i] for i in ids.values.to_numpy(zero_copy_only=False).tolist()]) if ids.is_valid else None for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns)), pa.array(texts, pa.binary())], [*batch.schema.names, "bytes"]
            )

    return decode


def _ranks(frame: DataFrame, ranks_path: str):
    """The file's lines, sent to the executors once; a vocabulary file is of a fixed size."""
    bounded_batches(frame.sparkSession)
    with open(ranks_path, "rb") as file:
        return frame.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the token ids of every row's whole text."""
    return documents_only(docs).mapInArrow(_encoder(pattern, _ranks(docs, ranks_path)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, ids, bytes): the bytes that every row's ids stand for; null ids give null."""
    return encoded.select("doc_id", "ids").mapInArrow(
        _decoder(_ranks(encoded, ranks_path)), "doc_id long, ids array<int>, bytes binary"
    )


def digest(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    return decode(encode(docs, ranks_path, pattern), ranks_path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
