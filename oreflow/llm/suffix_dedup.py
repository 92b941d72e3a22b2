"""Removal of long repeated byte strings by a sampled suffix array.

Of all suffixes only those at anchors are sorted. The anchor of a window of ``length`` bytes is
its string of ``ANCHOR`` bytes with the lowest hash, the leftmost if several have it. It depends on
the window's bytes alone, so equal windows have their anchors at the same offset, and windows can
be equal only where anchors are. Neighbouring windows mostly share their anchor: an anchor with all
its windows is a segment.

1. Anchors meet by hash. A segment equal to an earlier one is repeated as a whole. Where an anchor
   has several different segments, the first of each goes on; all other anchors are done.
2. Their suffixes are range-partitioned by their leading bytes, the anchor's, at sampled splitters;
   the suffixes of an anchor that fills half a bucket or more are dealt over several. Each bucket
   sorts its suffixes by multikey quicksort, and in the same way what stands before them, read
   backwards. Common prefixes of neighbours then tell for each offset which windows are equal;
   all but the first of equal windows are repeated.
3. Suffixes of an anchor that goes on in other buckets send the windows that are first in their
   bucket across: of equal ones all but the first are repeated.

A document is a row's whole text as UTF-8 bytes; a null text is empty. Strings never cross
documents. Documents are ordered by id, null ids last, and rows that share an id by a hash of their
text; rows equal in id and text are one document and get equal results. Texts shorter than
``length`` lose nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import bounded_batches, documents_only
from oreflow.session import materialise

LENGTH, ANCHOR = 100, 24
# Window starts of a text that are looked at together, and suffixes of a bucket.
SEGMENT, BUCKET = 1 << 20, 150_000
LAST_ID = (1 << 63) - 1

_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Anchors:
    """Finds the anchors of texts."""

    def __init__(self, length: int):
        self.length, self.powers, self.inverses = length, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            self.powers = np.cumprod(np.append(np.ones(1, np.uint64), np.full(n - 1, _P, np.uint64)))
            self.inverses = np.cumprod(np.append(np.ones(1, np.uint64), np.full(n - 1, _INVERSE, np.uint64)))

    def find(self, raw: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(hash of the anchor, hash of the segment, anchor's position, lowest and highest offset of it in its windows)."""
        for begin in range(0, len(raw) - self.length + 1, SEGMENT):
            part = raw[begin : begin + SEGMENT + self.length - 1]
            self._grow(min(SEGMENT + self.length, 1 << max(12, len(part).bit_length())))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.powers[: len(part)])])
            n = len(part) - ANCHOR + 1
            hashes = _mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * self.inverses[:n])
            # Hash above, place below: the lowest is the leftmost of the lowest hash.
            low = (hashes & ~np.uint64((1 << 24) - 1)) | np.arange(n, dtype=np.uint64)
            width, wide = 1, self.length - ANCHOR + 1
            while 2 * width <= wide:
                low = np.minimum(low[:-width], low[width:])
                width *= 2
            if width < wide:
                low = np.minimum(low[: len(low) - (wide - width)], low[wide - width :])
            place = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
            first = np.flatnonzero(np.diff(place, prepend=-1))
            last = np.append(first[1:], len(place)) - 1
            anchor = place[first]
            segment = _mixed((sums[last + self.length] - sums[first]) * self.inverses[first] + (last - first).astype(np.uint64))
            yield hashes[anchor], segment, begin + anchor, anchor - last, anchor - first


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length)
        waiting, size = [], 0

        def rows() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*waiting, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["anchor", "segment", "doc", "version", "place"])

        for batch in batches:
            for doc, version, text in zip(batch.column("doc").to_pylist(), batch.column("version").to_pylist(), batch.column("text"), strict=True):
                for anchor, segment, at, low, high in finder.find(np.frombuffer(text.as_buffer(), dtype=np.uint8)):
                    n = len(at)
                    waiting.append((anchor.view(np.int64), segment.view(np.int64), np.full(n, doc), np.full(n, version), (at << 16) | (low << 8) | high))
                    size += n
                    if size > 100_000:
                        yield rows()
                        waiting, size = [], 0
        if waiting:
            yield rows()

    return run


REPEATS = "kind int, doc long, version long, a long, b long, c long, anchor long"


def _split_segments(length: int):
    """From anchors in order: repeated byte ranges (kind 0: begin, end) and suffixes to compare (kind 1: position, offsets, and the anchor's hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last group's anchor, segment, the segment's first row, and that row if it still waits for a second segment.
        anchor = segment = None
        head: tuple = ()
        waiting: tuple | None = None
        for batch in batches:
            h, s, doc, version, place = (batch.column(x).to_numpy() for x in ("anchor", "segment", "doc", "version", "place"))
            n = len(h)
            if not n:
                continue
            new_anchor = np.ones(n, dtype=bool)
            new_anchor[1:] = h[1:] != h[:-1]
            new_anchor[0] = anchor is None or h[0] != anchor
            new_segment = new_anchor.copy()
            new_segment[1:] |= s[1:] != s[:-1]
            new_segment[0] |= s[0] != segment
            # For every row the first row of its segment; -1 is one of an earlier batch.
            first = np.maximum.accumulate(np.where(new_segment, np.arange(n), -1))
            same = np.where(
                first >= 0,
                (doc == doc[first]) & (version == version[first]) & (place == place[first]),
                (doc == head[0]) & (version == head[1]) & (place == head[2]) if head else False,
            )
            again = ~new_segment & ~same
            # First rows of segments whose anchor has another segment.
            starts = np.flatnonzero(new_segment)
            group = np.cumsum(new_anchor)[starts]  # 0: goes on from the batch before
            sizes = np.bincount(group, minlength=int(group.max(initial=0)) + 1)
            several = sizes[group] > 1
            goes_on = group == 0
            several |= goes_on  # the group had at least one segment before
            out = [(0, again), (1, np.zeros(n, dtype=bool))]
            last_anchor = int(np.flatnonzero(new_anchor)[-1]) if new_anchor.any() else -1
            extra = waiting if waiting is not None and goes_on.any() else None
            if extra is not None or (waiting is not None and last_anchor >= 0):
                waiting = None
            # A lone segment of the last group waits for the next batch.
            if last_anchor >= 0 and sizes[group[-1]] == 1 and group[-1] > 0:
                waiting = (doc[last_anchor], version[last_anchor], place[last_anchor], h[last_anchor])
            out[1][1][starts[several]] = True
            anchor, segment = h[-1], s[-1]
            if first[-1] >= 0:
                head = (doc[first[-1]], version[first[-1]], place[first[-1]])
            kinds, docs, versions, places, anchors = [], [], [], [], []
            for kind, mask in out:
                kinds.append(np.full(int(mask.sum()), kind, dtype=np.int32))
                docs.append(doc[mask])
                versions.append(version[mask])
                places.append(place[mask])
                anchors.append(h[mask])
            if extra is not None:
                kinds.append(np.ones(1, dtype=np.int32))
                docs.append(np.array([extra[0]]))
                versions.append(np.array([extra[1]]))
                places.append(np.array([extra[2]]))
                anchors.append(np.array([extra[3]]))
            kind, where = np.concatenate(kinds), np.concatenate(places)
            at, low, high = where >> 16, (where >> 8) & 255, where & 255
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (kind, np.concatenate(docs), np.concatenate(versions), np.where(kind == 0, at - high, at), np.where(kind == 0, at - low + length, low), np.where(kind == 0, 0, high), np.concatenate(anchors))],
                ["kind", "doc", "version", "a", "b", "c", "anchor"],
            )

    return run


def _suffixes(length: int):
    """(head, before, doc, version, at, low, high, part): the bytes from each anchor on, and those before it read backwards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, version, text, anchors in zip(*(batch.column(x) for x in ("doc", "version", "text", "anchors")), strict=True):
                raw, doc, version = text.as_buffer().to_pybytes(), doc.as_py(), version.as_py()
                for anchor in anchors.as_py():
                    at = anchor["a"]
                    before = raw[max(at - length + ANCHOR, 0) : at][::-1]
                    rows.append((raw[at : at + length].ljust(length, b"\0"), before.ljust(length - ANCHOR, b"\0"), doc, version, at, anchor["b"], anchor["c"], anchor["part"]))
                if len(rows) > 50_000:
                    yield _rows(rows)
                    rows = []
            if rows:
                yield _rows(rows)

    return run


SUFFIX = "head binary, before binary, doc long, version long, at long, low int, high int, part int"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    names = ["head", "before", "doc", "version", "at", "low", "high", "part"]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def multikey_quicksort(strings: np.ndarray) -> np.ndarray:
    """The order of the rows of a table of bytes: three-way partitions by eight bytes at a time, small parts by comparison."""
    n, width = strings.shape
    words = np.zeros((n, -(-width // 8) * 8), dtype=np.uint8)
    words[:, :width] = strings
    words = words.view(">u8").astype(np.uint64)
    whole = np.ascontiguousarray(strings).view(f"S{width}").ravel()
    order = np.arange(n)
    open_ = [(0, n, 0)]
    while open_:
        begin, end, depth = open_.pop()
        part = order[begin:end]
        if end - begin < 2 or depth == words.shape[1]:
            continue
        if end - begin <= 1024:
            order[begin:end] = part[np.argsort(whole[part], kind="stable")]
            continue
        word = words[part, depth]
        some = word[:: max(1, len(word) // 255)]
        pivot = np.partition(some, len(some) // 2)[len(some) // 2]
        less, equal = word < pivot, word == pivot
        a, b = begin + int(less.sum()), begin + int(less.sum()) + int(equal.sum())
        order[begin:end] = np.concatenate([part[less], part[equal], part[word > pivot]])
        open_ += [(begin, a, depth), (a, b, depth + 1), (b, end, depth)]
    return order


def common_prefixes(strings: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many leading bytes each string in order shares with the one before; 0 for the first."""
    ranked = strings[order]
    common = np.zeros(len(order), dtype=np.int64)
    for begin in range(1, len(order), 1 << 16):
        end = min(begin + (1 << 16), len(order))
        differ = ranked[begin:end] != ranked[begin - 1 : end - 1]
        common[begin:end] = np.where(differ.any(axis=1), differ.argmax(axis=1), strings.shape[1])
    return common


FOUND = "kind int, doc long, version long, a long, b long, window binary"


def _buckets(length: int):
    """Repeated ranges of a bucket (kind 0: begin, end), and windows that are first in it but may be repeated in another (kind 1: start).

    ``part`` is positive for suffixes whose anchor is dealt over several buckets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [batch for batch in batches if batch.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        heads = np.frombuffer(b"".join(table.column("head").to_pylist()), dtype=np.uint8).reshape(-1, length)
        backs = np.frombuffer(b"".join(table.column("before").to_pylist()), dtype=np.uint8).reshape(-1, length - ANCHOR)
        doc, version, at, low, high, part = (table.column(x).to_numpy() for x in ("doc", "version", "at", "low", "high", "part"))
        n = len(doc)
        by_place = np.lexsort((at, version, doc))
        # Rows of equal documents are the same occurrence.
        follows = np.zeros(n, dtype=bool)
        follows[1:] = (np.diff(doc[by_place]) == 0) & (np.diff(version[by_place]) == 0) & (np.diff(at[by_place]) == 0)
        place = np.empty(n, dtype=np.int64)
        place[by_place] = np.cumsum(~follows)

        def ranked(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            order = multikey_quicksort(strings)
            return order, common_prefixes(strings, order)

        head_order, head_common = ranked(heads)
        back_order, back_common = ranked(backs)
        opens = part > 0
        span = length - ANCHOR + 1
        repeated, first_open = np.zeros((n, span + 1), dtype=bool), []
        for offset in range(span):
            head_class, back_class = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
            head_class[head_order] = np.cumsum(head_common < length - offset)
            back_class[back_order] = np.cumsum(back_common < offset) if offset else 0
            active = by_place[((low <= offset) & (offset <= high))[by_place]]
            if not len(active):
                continue
            _, first, which = np.unique(head_class[active] * (n + 1) + back_class[active], return_index=True, return_inverse=True)
            repeated[active, offset] = place[active] != place[active[first]][which]
            lone = active[first]
            first_open.append(np.stack([lone[opens[lone]], np.full(int(opens[lone].sum()), offset)]))
        change = np.diff(repeated.astype(np.int8), axis=1, prepend=0)
        row, begin = np.nonzero(change == 1)
        _, end = np.nonzero(change == -1)
        # Offsets ``begin`` to ``end - 1`` of a row are one range of bytes.
        for k in range(0, len(row), 100_000):
            r, b, e = row[k : k + 100_000], begin[k : k + 100_000], end[k : k + 100_000]
            yield _found(0, doc[r], version[r], at[r] - (e - 1), at[r] - b + length, [None] * len(r))
        if first_open:
            rows, offsets = np.concatenate(first_open, axis=1)
            for k in range(0, len(rows), 100_000):
                r, o = rows[k : k + 100_000], offsets[k : k + 100_000]
                windows = [hashlib.blake2b(backs[i, :x][::-1].tobytes() + heads[i, : length - x].tobytes(), digest_size=16).digest() for i, x in zip(r.tolist(), o.tolist(), strict=True)]
                yield _found(1, doc[r], version[r], at[r] - o, at[r] - o + length, windows)

    return run


def _found(kind: int, doc, version, begin, end, windows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(doc), kind, dtype=np.int32)), *(pa.array(np.asarray(x, dtype=np.int64)) for x in (doc, version, begin, end)), pa.array(windows, pa.binary())],
        ["kind", "doc", "version", "a", "b", "window"],
    )


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, version, begin, end): ranges of bytes that earlier text repeats; ``doc`` is the id, or the highest long for null."""
    bounded_batches(docs.sparkSession)
    texts = _texts(docs)
    rows = texts.where(F.octet_length("text") >= length).mapInArrow(
        _anchor_rows(length), "anchor long, segment long, doc long, version long, place long"
    )
    dealt = rows.repartition("anchor").sortWithinPartitions("anchor", "segment", "doc", "version", "place")
    split = materialise(dealt.mapInArrow(_split_segments(length), REPEATS), "segments")
    compared = split.where("kind = 1")
    n = compared.count()
    # Fewer than 2 n / BUCKET anchors.
    large = compared.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET // 2)
    parts = large.select("anchor", F.ceil(F.col("n") / (BUCKET // 2)).cast("int").alias("parts"))
    dealt_out = compared.join(materialise(parts, "large-anchors"), "anchor", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("doc", "version", "a"), F.col("parts")).cast("int") + 1, F.lit(0))
    )
    anchors = dealt_out.groupBy("doc", "version").agg(F.collect_list(F.struct("a", "b", "c", "part")).alias("anchors"))
    suffixes = texts.join(anchors, ["doc", "version"]).mapInArrow(_suffixes(length), SUFFIX)
    ranged = suffixes.repartitionByRange(max(1, math.ceil(n / BUCKET)), F.substring("head", 1, ANCHOR), "part")
    found = materialise(ranged.mapInArrow(_buckets(length), FOUND), "buckets")
    across = found.where("kind = 1")
    firsts = across.groupBy("window").agg(F.min(F.struct("doc", "version", "a")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = across.join(materialise(firsts, "across"), "window").where(F.struct("doc", "version", "a") != F.col("first"))
    ranges = [split.where("kind = 0"), found.where("kind = 0"), later]
    begin_end = [x.select("doc", "version", F.col("a").alias("begin"), F.col("b").alias("end")) for x in ranges]
    return begin_end[0].unionByName(begin_end[1]).unionByName(begin_end[2])


def _texts(docs: DataFrame) -> DataFrame:
    return documents_only(docs).select("doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), F.xxhash64("text").alias("version"), "text")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, spans, kept = [], [], [], []
        for text, ranges in zip(batch.column("text"), batch.column("ranges"), strict=True):
            raw = text.as_buffer().to_pybytes()
            merged: list[list[int]] = []
            for begin, end in sorted((r["begin"], r["end"]) for r in ranges.as_py() or ()):
                if merged and begin <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([begin, end])
            edges = [0, *(x for span in merged for x in span), len(raw)]
            sizes.append(len(raw))
            removed.append(sum(end - begin for begin, end in merged))
            spans.append([{"begin": begin, "end": end} for begin, end in merged])
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of every row: the removed runs and the bytes that are left."""
    ranges = materialise(repeated_ranges(docs, length), "ranges")
    gathered = ranges.groupBy("doc", "version").agg(F.collect_set(F.struct("begin", "end")).alias("ranges"))
    return (
        _texts(docs)
        .join(gathered, ["doc", "version"], "left")
        .select("doc_id", "text", "ranges")
        .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<begin:long,end:long>>, kept binary")
    )


def digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    return remove_repeats(docs, length).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
