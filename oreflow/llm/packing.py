"""Packing of tokenised documents into sequences of a fixed length.

A document is cut into full windows and a rest. The histogram of rests is matched by combinations
of a few lengths that fill a window exactly: non-negative least squares gives how often each
combination is to be repeated, the numbers are rounded to what the histogram holds, and each
document takes its place by its number among the rests of its length. What no combination takes
is packed greedily, one document after the other, cut where a window ends; the last window's
tokens go into sequences whose lengths are powers of two, which need no padding.

A null text is an empty document, which still holds the closing id. Rows are documents of their
own, repeated or not, with or without an id. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import bounded_batches, documents_only
from oreflow.session import materialise

WINDOW, CLOSING = 4096, 2
# Bytes of words that a Python worker remembers before it starts afresh, about, and the longest of them in characters.
REMEMBERED, SHORT, ENTRY = 160 << 20, 64, 160
# Rows of one length that one task numbers, on average.
NUMBERED = 20_000
# Most lengths of a combination.
DEPTH = 6
NOT_LATIN = re.compile("[^\t-\r -~À-ÖØ-öø-ÿ]")
# Marks that close a word after a letter or digit, in lower-case Latin texts.
MARKS = re.compile(r"[.,;:!?*#$%&|](?<=[0-9a-zß-öø-ÿ].)[.,;:!?*#$%&|]*(?!\S)")
WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")
LOWER = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"

# Characters of texts that are tokenised together.
TOGETHER = 1 << 20

NAMES, KINDS = ("row", "doc_id", "n_tokens", "crcs", "ids"), (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
TOKENS = "row long, doc_id long, n_tokens long, crcs array<long>, ids binary"
# Python workers run one task after another; what a tokenizer has learnt in one task stays for the next.
_TOKENIZERS: dict[int, WordTokenizer] = {}

PIECES = "row long, doc_id long, doc_tokens long, start long, length long, sequence_id long, offset long"


class WordTokenizer:
    """Ids of a text as 32-bit numbers, from a tokenizers file whose pieces never hold white space.

    Words between ASCII white space are tokenised once per Python process and remembered.
    """

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        self.plain, self.separated = Tokenizer.from_str(text), Tokenizer.from_str(text)
        self.plain.encode_special_tokens = True  # their strings in a text are ordinary text
        special = [(t.content, i) for i, t in self.plain.get_added_tokens_decoder().items() if t.special]
        self.mark, self.mark_id = special[0] if special else (None, None)
        # Ids that end a piece, if the vocabulary tells them apart.
        suffix = getattr(self.plain.model, "end_of_word_suffix", None)
        vocabulary = self.plain.get_vocab(with_added_tokens=False)
        self.letters = None
        if suffix:
            self.closes = np.zeros(max(vocabulary.values()) + 1 + len(special), dtype=bool)
            self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
            self._prepare_letters()
        self.known: dict[str, bytes] = {}
        self.size = 0

    def _prepare_letters(self) -> None:
        """A tokenizer for lower-case Latin letters that leaves out the steps that change nothing in them.

        It gets their bytes as the letters that the vocabulary has for them. It is used if it splits every pair of letters
        as the whole tokenizer does.
        """
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Split

        letters = Tokenizer(self.plain.model)
        letters.pre_tokenizer = Split(" ", "removed")
        in_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_letters = {ord(c): in_bytes.pre_tokenize_str(c)[0][0] for c in LOWER}
        pairs = " ".join(a + b for a in LOWER for b in LOWER)
        if letters.encode(pairs.translate(self.byte_letters), add_special_tokens=False).ids == self.plain.encode(pairs, add_special_tokens=False).ids:
            self.letters = letters

    def _learn(self, words: list[str], latin: bool) -> None:
        """Remembers the ids of ``words``.

        Words of Latin letters alone are one piece each, which its last id shows; others are parted by a special token.
        """
        pieces = [word for word in words if word.isalpha() and (latin or word.isascii())] if self.letters else []
        for begin in range(0, len(pieces), 500):
            some = pieces[begin : begin + 500]
            ids = self._ids(self.letters, " ".join(some).lower().translate(self.byte_letters))
            self._remember(some, ids, np.flatnonzero(self.closes[ids]) + 1, 0)
        if len(pieces) < len(words):
            done = set(pieces)
            others = [word for word in words if word not in done]
            for begin in range(0, len(others), 500):
                some = others[begin : begin + 500]
                if self.mark is None:
                    self._remember(some, np.zeros(0, dtype="<u4"), np.zeros(0, dtype=int), 0)
                    continue
                ids = self._ids(self.separated, self.mark.join(some))
                self._remember(some, ids, np.append(np.flatnonzero(ids == self.mark_id), len(ids)), 1)

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _remember(self, words: list[str], ids: np.ndarray, ends: np.ndarray, skip: int) -> None:
        """Cuts the ids of words tokenised as one string at ``ends``; words are tokenised one by one if their ends don't show."""
        if len(ends) != len(words):
            self.known.update(zip(words, map(self.whole, words), strict=True))
            return
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        begins = [0, *(end + 4 * skip for end in ends[:-1])]
        self.known.update(zip(words, [raw[a:b] for a, b in zip(begins, ends, strict=True)], strict=True))

    def whole(self, text: str) -> bytes:
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Words that are new in any of the texts are tokenised together."""
        kinds = [not NOT_LATIN.search(text) for text in texts]
        # Latin letters are lower-cased before anything else, and marks after a letter or digit are pieces of their own.
        lists = [MARKS.sub(r" \g<0>", text.lower()).split() if latin else WORD.findall(text) for text, latin in zip(texts, kinds, strict=True)]
        known, own = self.known, {}
        if self.size > REMEMBERED:
            known.clear()
            self.size = 0
        before = len(known)
        for latin in (True, False):
            new = set().union(*[words for words, kind in zip(lists, kinds, strict=True) if kind == latin])
            new = new.difference(known)
            # Very long words, and words that may look like special tokens, are not joined to others or remembered.
            apart = [word for word in new if len(word) > SHORT or "<|" in word]
            own.update((word, self.whole(word)) for word in apart)
            new.difference_update(apart)
            self._learn(list(new), latin)
        # Words of up to ``SHORT`` characters; their ids take no more than four bytes for each of theirs.
        self.size += (len(known) - before) * (ENTRY + SHORT // 2)
        known.update(own)
        encoded = [b"".join(map(known.__getitem__, words)) for words in lists]
        for word in own:
            del known[word]
        return encoded


def _word_tokenizer(text: str) -> WordTokenizer:
    """This process's tokenizer of a tokenizers file."""
    key = hash(text)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = WordTokenizer(text)
    return _TOKENIZERS[key]


def _tokenise(tokenizer_json, window: int, closing: int, narrow: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = _word_tokenizer(tokenizer_json.value)
        end, row = np.array([closing], dtype="<u4").tobytes(), TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc_ids, texts in _together(batch):
                encoded = [ids + end for ids in tokenizer.encode(texts)]
                crcs = [[zlib.crc32(ids[at : at + 4 * window]) for at in range(0, len(ids), 4 * window)] for ids in encoded]
                sizes = [len(ids) // 4 for ids in encoded]
                if narrow:
                    encoded = [np.frombuffer(ids, "<u4").astype("<u2").tobytes() for ids in encoded]
                columns = (range(row, row + len(encoded)), doc_ids, sizes, crcs, encoded)
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, KINDS, strict=True)], NAMES)
                row += len(encoded)

    return run


def _together(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of some rows at a time, few enough to tokenise together."""
    doc_ids, texts, size = [], [], 0
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
        doc_ids.append(doc_id)
        texts.append(text.as_py())
        size += len(texts[-1])
        if size > TOGETHER:
            yield doc_ids, texts
            doc_ids, texts, size = [], [], 0
    if texts:
        yield doc_ids, texts


def tokenise(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, closing: int = CLOSING) -> DataFrame:
    """(row, doc_id, n_tokens, crcs, ids): every row's ids and the closing id, as little-endian numbers.

    Ids take two bytes if none of the vocabulary needs more, else four. ``row`` numbers the rows, ``crcs``
    has the checksum of the ids of each window, as 32-bit numbers. Written once, as the numbers must not
    change when a task runs again.
    """
    from tokenizers import Tokenizer

    bounded_batches(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as file:
        text = file.read()
    narrow = max(closing, *Tokenizer.from_str(text).get_vocab().values()) < 1 << 16
    shared = docs.sparkSession.sparkContext.broadcast(text)
    return materialise(documents_only(docs).mapInArrow(_tokenise(shared, window, closing, narrow), TOKENS), "tokens")


def combinations(histogram: dict[int, int], window: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Combinations of up to ``depth`` lengths of the histogram that fill the window exactly.

    Each length is joined by others of even shares of what is left, or of shares of which each is
    twice the next, moved to lengths that occur; the last one closes the window.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    found = set()

    def near(wanted: int) -> int:
        at = int(np.searchsorted(lengths, wanted))
        around = lengths[max(at - 1, 0) : at + 1]
        return int(around[np.abs(around - wanted).argmin()])

    for first in lengths.tolist():
        for others in range(1, depth):
            for ratio in (1, 2):
                for shift in (0, 1, -1):
                    parts, left = [first], window - first
                    for k in range(others - 1, 0, -1):
                        share = left * ratio**k // sum(ratio**i for i in range(k + 1)) if ratio > 1 else left // (k + 1)
                        parts.append(near(share + shift * max(1, share // 7)))
                        left -= parts[-1]
                        if left <= 0:
                            break
                    if left in histogram:
                        found.add(tuple(sorted([*parts, left], reverse=True)))
    return sorted(found, reverse=True)


def solve_repeats(histogram: dict[int, int], combos: list[tuple[int, ...]], window: int, rounds: int = 400) -> list[int]:
    """How often to use each combination: non-negative least squares by accelerated projected gradients, then rounding.

    The objective is the squared difference between the lengths used and the histogram. Rounding
    takes the combinations in descending order and never more than the histogram still holds.
    """
    if not combos:
        return []
    column = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    length = np.fromiter((x for c in combos for x in c), dtype=np.int64)
    wanted = np.zeros(window + 1)
    wanted[list(histogram)] = list(histogram.values())

    def used(x: np.ndarray) -> np.ndarray:
        return np.bincount(length, weights=x[column], minlength=window + 1)

    def slope(residual: np.ndarray) -> np.ndarray:
        return np.bincount(column, weights=residual[length], minlength=len(combos))

    probe = np.ones(len(combos))
    for _ in range(20):  # the largest curvature, by powers
        probe = slope(used(probe))
        steepest = float(np.linalg.norm(probe))
        probe /= steepest
    x = ahead = np.zeros(len(combos))
    momentum = 1.0
    for _ in range(rounds):
        nearer = np.maximum(ahead - slope(used(ahead) - wanted) / (1.05 * steepest), 0)
        faster = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = nearer + (momentum - 1) / faster * (nearer - x)
        x, momentum = nearer, faster

    left, repeats = dict(histogram), [0] * len(combos)
    for bound in (np.floor(x + 0.5), np.ceil(x)):
        for c in np.argsort(-x, kind="stable").tolist():
            parts = combos[c]
            most = min(int(bound[c]) - repeats[c], *(left[part] // parts.count(part) for part in parts))
            if most > 0:
                repeats[c] += most
                for part in parts:
                    left[part] -= most
    return repeats


@dataclass(frozen=True)
class Plan:
    """Where the k-th rest of a length goes.

    ``starts`` holds ``length << 40 | first k`` of every run of places, ascending; a run belongs to
    a combination (its first sequence and the offset there) or to the greedy part (its position).
    """

    window: int
    starts: np.ndarray
    greedy: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    edges: np.ndarray
    sequences: int

    def place(self, rest: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(run, whether the run is greedy, the number within the run)."""
        run = np.searchsorted(self.starts, (rest << 40) | k, side="right") - 1
        return run, self.greedy[run], k - (self.starts[run] & ((1 << 40) - 1))


def make_plan(histogram: dict[int, int], window: int = WINDOW) -> Plan:
    combos = combinations(histogram, window)
    repeats = solve_repeats(histogram, combos, window)
    taken = dict.fromkeys(histogram, 0)
    runs, sequences = [], 0
    for combo, n in zip(combos, repeats, strict=True):
        if n:
            offset = 0
            for part in combo:
                runs.append(((part << 40) | taken[part], False, sequences, offset))
                taken[part] += n
                offset += part
            sequences += n
    position = 0
    for length in sorted(histogram, reverse=True):
        if rest := histogram[length] - taken[length]:
            runs.append(((length << 40) | taken[length], True, position, length))
            position += rest * length
    # The greedy part's tokens: where its sequences begin.
    whole = position // window * window
    edges, at = [], whole
    for bit in range(window.bit_length() - 1, -1, -1):
        if (position - whole) >> bit & 1:
            edges.append(at)
            at += 1 << bit
    runs.sort()
    columns = [np.array(x, dtype=t) for x, t in zip(zip(*runs, strict=True), (np.int64, bool, np.int64, np.int64), strict=True)] if runs else [
        np.zeros(0, dtype=t) for t in (np.int64, bool, np.int64, np.int64)
    ]
    return Plan(window, *columns, np.array([whole, *edges, position], dtype=np.int64), sequences)


def _pieces(plan: Plan, first_full: int):
    """Pieces of each document from its number ``k`` among the rests of its length and its first full sequence."""
    window = plan.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, n, rest, k, full = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("row", "n_tokens", "rest", "k", "full_before"))
            out = []

            def add(at, start, length, sequence, offset):
                out.append(np.stack([at, start, length, sequence, offset]))  # noqa: B023

            windows = n // window
            at = np.repeat(np.arange(len(n)), windows)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(windows) - windows, windows)
            add(at, nth * window, np.full(len(at), window), first_full + full[at] + nth, np.zeros(len(at), dtype=np.int64))
            at = np.flatnonzero(rest > 0)
            if len(at):
                place, greedy, nth = plan.place(rest[at], k[at])
                fixed = at[~greedy]
                add(fixed, windows[fixed] * window, rest[fixed], (plan.first[place] + nth)[~greedy], plan.offset[place][~greedy])
                # Greedy: a range of positions, cut where sequences end.
                loose = at[greedy]
                begin = (plan.first[place] + nth * rest[at])[greedy]
                end, start = begin + rest[loose], windows[loose] * window
                whole, edges = plan.edges[0], plan.edges[1:]
                while len(loose):
                    in_tail = begin >= whole
                    edge = np.searchsorted(edges, begin, side="right")
                    stop = np.minimum(np.where(in_tail, edges[np.minimum(edge, len(edges) - 1)], (begin // window + 1) * window), end)
                    tail = np.maximum(edge - 1, 0)
                    sequence = plan.sequences + np.where(in_tail, whole // window + tail, begin // window)
                    add(loose, start, stop - begin, sequence, np.where(in_tail, begin - edges[tail], begin % window))
                    start, begin = start + stop - begin, stop
                    more = begin < end
                    loose, begin, end, start = loose[more], begin[more], end[more], start[more]
            at, start, length, sequence, offset = np.concatenate(out, axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (row[at], *(y.astype(np.int64) for y in (n[at], start, length, sequence, offset)))] + [batch.column("doc_id").take(pa.array(at))],
                ["row", "doc_tokens", "start", "length", "sequence_id", "offset", "doc_id"],
            ).select(["row", "doc_id", "doc_tokens", "start", "length", "sequence_id", "offset"])

    return run


def pack(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, doc_id, doc_tokens, start, length, sequence_id, offset): every piece of (row, doc_id, n_tokens)."""
    items = tokens.select(
        "row", "doc_id", "n_tokens", (F.col("n_tokens") % window).alias("rest"), F.floor(F.col("n_tokens") / window).alias("full")
    )
    # At most one row per length of a rest.
    by_rest = {r["rest"]: r for r in items.groupBy("rest").agg(F.count("*").alias("n"), F.sum("full").alias("full")).collect()}
    plan = make_plan({rest: r["n"] for rest, r in by_rest.items() if rest}, window)
    greedy = int(plan.edges[0] // window + len(plan.edges) - 2)
    first_full, before, full_bases = plan.sequences + max(greedy, 0), 0, {}
    for rest in sorted(by_rest):
        full_bases[rest] = before
        before += by_rest[rest]["full"]

    # Numbers among the rests of a length: within salted parts, plus the parts before. No part grows with a frequent length.
    parts = max(1, -(-max((r["n"] for r in by_rest.values()), default=0) // NUMBERED))
    salted = items.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts).cast("long")))
    sizes = salted.groupBy("rest", "part").agg(F.count("*").alias("rows"), F.sum("full").alias("fulls"))
    earlier = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        "rest", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("k0"), F.coalesce(F.sum("fulls").over(earlier), F.lit(0)).alias("f0")
    )
    own = Window.partitionBy("rest", "part").orderBy("row")
    so_far = own.rowsBetween(Window.unboundedPreceding, -1)
    numbered = salted.select(
        "*", (F.row_number().over(own) - 1).alias("k1"), F.coalesce(F.sum("full").over(so_far), F.lit(0)).alias("f1")
    ).join(bases, ["rest", "part"])
    rest_base = tokens.sparkSession.createDataFrame(list(full_bases.items()), "rest long, b0 long")
    located = numbered.join(rest_base, "rest").select(
        "row", "doc_id", "n_tokens", "rest",
        (F.col("k0") + F.col("k1")).alias("k"), (F.col("b0") + F.col("f0") + F.col("f1")).alias("full_before"),
    )
    return located.mapInArrow(_pieces(plan, first_full), PIECES)


def with_checksums(pieces: DataFrame, tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds ``ids_crc32``. Pieces that are a window or a rest have theirs from ``tokens``; cut ones look their ids up."""
    stored = materialise(pieces, "pieces")
    plain = (F.col("start") % window == 0) & ((F.col("length") == window) | (F.col("start") + F.col("length") == F.col("doc_tokens")))
    known = stored.where(plain).join(tokens.select("row", "crcs"), "row").select(
        *stored.columns, F.get("crcs", (F.col("start") / window).cast("int")).alias("ids_crc32")
    )
    cut = _own_ids(stored.where(~plain), tokens).mapInArrow(_checked, f"{PIECES}, ids_crc32 long")
    return known.unionByName(cut)


def _own_ids(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """``pieces`` with their own part of the stored ids."""
    width = F.octet_length("ids") / F.col("doc_tokens")
    own = F.substring("ids", (width * F.col("start") + 1).cast("int"), (width * F.col("length")).cast("int"))
    return pieces.join(tokens.select("row", "ids"), "row").select(*pieces.columns, own.alias("ids"))


def _wide(batch: pa.RecordBatch) -> list[bytes]:
    """The ids of each piece as 32-bit numbers."""
    sizes = batch.column("length").to_pylist()
    return [ids if len(ids) == 4 * n else np.frombuffer(ids, "<u2").astype("<u4").tobytes() for ids, n in zip(batch.column("ids").to_pylist(), sizes, strict=True)]


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.drop_columns(["ids"]).append_column("ids_crc32", pa.array([zlib.crc32(ids) for ids in _wide(batch)], pa.int64()))


def _widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.drop_columns(["ids"]).append_column("ids", pa.array(_wide(batch), pa.binary()))


def with_ids(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """Adds ``ids``, the ids of every piece as little-endian 32-bit numbers."""
    return _own_ids(pieces, tokens).mapInArrow(_widened, f"{PIECES}, ids binary")


def digest(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """The contract's columns of every piece."""
    tokens = tokenise(docs, tokenizer_path, window)
    return with_checksums(pack(tokens, window), tokens, window).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
