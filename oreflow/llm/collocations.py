"""Phrase collocations: phrases of two to four words that stand together more often than apart.

The words of each input partition are cut into shards of one language, about ``SHARD_WORDS`` words each.
Per shard an FM-index over word ids (:mod:`phrase_index`) counts phrases by extending the
intervals of shorter ones, and counts are summed across shards, in two rounds, so that rare phrases
never leave their shard as rows:

1. Words that occur ``least`` times get ids. Every shard extends its words to pairs and sends the counts, packed and
   sorted, to the buckets that own the pairs. A bucket sums them and answers each shard with one bit per pair: often
   enough or not.
2. Every shard keeps the stretches of frequent pairs, indexes them in both directions, extends pairs to the left
   and the results to the right, and sends the counts of these phrases of three and four words as rows.

A phrase is as frequent as its rarest part at most, so nothing is lost. Words are identified by 64-bit
hashes inside shards only; all distinct words are compared, and if two of a language share a hash,
another seed is taken.

A null text has no words, a null language is ``und``. A text is read whole whatever its length and may alone
exceed a shard's size. Repeated rows count as often as they are there; ids are not used and may be null or
repeat. An empty table, or one without frequent phrases, gives an empty result. Ties are resolved
as in :func:`ranked`. Only ``lang`` and ``text`` are read, other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count as numbers

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import ascii_lower, bounded_batches
from oreflow.llm.numbering import numbered
from oreflow.llm.phrase_index import PhraseIndex
from oreflow.session import materialise

# What ends a piece, what separates words.
PIECE_END, WORD_GAP = r"[.,;:!?\x0A-\x0D]+", r"[\x20\x09]+"
# Words of a shard and pairs of a bucket, about.
SHARD_WORDS, BUCKET_PAIRS = 5 << 18, 1 << 21
# The longest phrases, in words.
LONGEST = 4

SHARDS = "shard long, lang string, words array<long>, text binary"
PAIRS = "bucket int, shard long, pairs binary, counts binary"
ANSWERS = "shard long, bucket int, bits binary, pair long, n long"
LONGER = "a long, b long, n long"


def tokens(docs: DataFrame) -> DataFrame:
    """(lang, words) of every row; the ends of pieces are the word ``\\n``."""
    text = F.regexp_replace(ascii_lower(F.coalesce("text", F.lit(""))), PIECE_END, " \n ")
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), words.alias("words"))


def dictionary(split: DataFrame) -> tuple[DataFrame, int]:
    """(lang, word, f, hash) of all words, and the first seed with which no two words of a language share a hash."""
    words = split.select("lang", F.explode("words").alias("word")).where("word <> '\n'")
    counted = materialise(words.groupBy("lang", "word").agg(F.count("*").alias("f")), "words")
    for seed in numbers():
        hashed = counted.withColumn("hash", F.xxhash64(F.lit(seed), "word"))
        if hashed.groupBy("lang", "hash").count().where("count > 1 OR hash = 0").isEmpty():
            return hashed, seed


def _pack(values: np.ndarray) -> bytes:
    """A compressed array: bytes of equal weight stand together, as most high ones are zero."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    planes = pa.decompress(packed[8:], 8 * n, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).view("<i8").ravel()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of the rows (lang, hashes) of one partition, each with its distinct hashes and the words as places in them, from 1 on."""
    shard = TaskContext.get().partitionId() << 32
    held: dict[str, list[np.ndarray]] = {}
    sizes: dict[str, int] = {}
    end = np.zeros(1, np.int64)

    def written(lang: str) -> pa.RecordBatch:
        words, text = np.unique(np.concatenate(held.pop(lang)), return_inverse=True)
        zero = int(np.searchsorted(words, 0))
        place = np.arange(len(words)) + 1
        place[zero:] -= 1
        place[zero] = 0
        return pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.array([lang]), pa.array([np.delete(words, zero)], pa.list_(pa.int64())), pa.array([_pack(place[text.ravel()])], pa.binary())],
            names=["shard", "lang", "words", "text"],
        )

    for batch in batches:
        lists = batch.column(1)
        ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        for row, lang in enumerate(batch.column(0).to_pylist()):
            own = values[ends[row] : ends[row + 1]]
            if not len(own):
                continue
            held.setdefault(lang, [end]).extend((own.copy(), end))
            sizes[lang] = sizes.get(lang, 0) + len(own)
            if sizes[lang] >= SHARD_WORDS:
                yield written(lang)
                sizes[lang] = 0
                shard += 1
    for lang in list(held):
        yield written(lang)
        shard += 1


def shards(split: DataFrame, seed: int) -> DataFrame:
    """The words of each partition in shards of one language."""
    bounded_batches(split.sparkSession)
    hashes = F.transform("words", lambda w: F.when(w == "\n", F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(seed), w)))
    return materialise(split.select("lang", hashes.alias("hashes")).mapInArrow(_cut, SHARDS), "shards")


def _frequent_text(shard: pa.Table, ids: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The shard's text with frequent words numbered from 1 on by their id, all others 0; and the ids, with 0 first."""
    local, word = ids.column("place").to_numpy(), ids.column("id").to_numpy()
    order = np.argsort(word)
    table = np.zeros(len(shard.column("words")[0]) + 1, np.int64)
    table[local[order]] = np.arange(1, len(order) + 1)
    text = table[_unpack(shard.column("text")[0].as_py())]
    # One 0 ends a piece as well as many do.
    keep = np.concatenate([[True], (text[1:] > 0) | (text[:-1] > 0)])
    return np.append(text[keep], 0), np.concatenate([[0], word[order]])


def _pairs(text: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shard's pairs of frequent words in order, as two ids in one number, and their counts."""
    index = PhraseIndex(text, len(ids), 1)
    found = index.extend(index.words(), left=True)
    pairs = ids[found.words[:, 0]] << 32 | ids[found.words[:, 1]]
    order = np.argsort(pairs)
    return pairs[order], found.count[order]


def _bucket(pairs: np.ndarray, buckets: int) -> np.ndarray:
    mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def _send_pairs(buckets: int):
    def send(shard: pa.Table, ids: pa.Table) -> pa.Table:
        rows: dict[str, list] = {"bucket": [], "shard": [], "pairs": [], "counts": []}
        if len(shard) and len(ids):
            pairs, count = _pairs(*_frequent_text(shard, ids))
            owner = _bucket(pairs, buckets)
            for bucket in np.unique(owner).tolist():
                own = owner == bucket
                rows["bucket"].append(bucket)
                rows["shard"].append(shard.column("shard")[0].as_py())
                rows["pairs"].append(_pack(np.diff(pairs[own], prepend=0)))
                rows["counts"].append(_pack(count[own]))
        return pa.table(rows, pa.schema([("bucket", pa.int32()), ("shard", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary())]))

    return send


def _sum_pairs(least: int):
    def answer(blocks: pa.Table) -> pa.Table:
        sent = [np.cumsum(_unpack(x.as_py())) for x in blocks.column("pairs")]
        every = np.concatenate(sent)
        order = np.argsort(every, kind="stable")
        pairs, first = np.unique(every[order], return_index=True)
        total = np.add.reduceat(np.concatenate([_unpack(x.as_py()) for x in blocks.column("counts")])[order], first)
        often, total = pairs[total >= least], total[total >= least]
        bucket = blocks.column("bucket")[0].as_py()
        bits = [np.packbits(np.isin(own, often)).tobytes() for own in sent]
        n, none = len(often), [None] * len(sent)
        return pa.table(
            {
                "shard": pa.array(blocks.column("shard").to_pylist() + [None] * n, pa.int64()),
                "bucket": pa.array([bucket] * (n + len(sent)), pa.int32()),
                "bits": pa.array(bits + [None] * n, pa.binary()),
                "pair": pa.array(none + often.tolist(), pa.int64()),
                "n": pa.array(none + total.tolist(), pa.int64()),
            }
        )

    return answer


def _stretches(text: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """The stretches of at least three words of ``text`` in which each word is ``joined`` to the next, with a 0 after each."""
    before = np.concatenate([[False], joined[:-1]])
    # Of three words at least: a word belongs to one if it is joined on both sides, or to a word that is.
    middle = before & joined
    keep = middle | np.append(middle[1:], False) & joined | np.concatenate([[False], middle[:-1]]) & before
    last = keep & ~joined
    places = np.arange(len(text)) + np.cumsum(last) - last
    out = np.zeros(len(text) + int(last.sum()) + 1, np.int64)
    out[places[keep]] = text[keep]
    used = np.zeros(len(out), bool)
    used[places[keep]] = True
    used[places[last] + 1] = True
    return np.append(out[used], 0)


def _send_longer(buckets: int):
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})

    def send(shard: pa.Table, told: pa.Table) -> pa.Table:
        ids = told.filter(pc.is_valid(told.column("id"))) if len(told) else told
        if not len(shard) or not len(ids):
            return none
        text, word = _frequent_text(shard, ids)
        pairs, _ = _pairs(text, word)
        owner, often = _bucket(pairs, buckets), np.zeros(len(pairs), bool)
        for bucket, bits in zip(told.column("bucket").to_pylist(), told.column("bits").to_pylist(), strict=True):
            if bits is not None:
                own = np.flatnonzero(owner == bucket)
                often[own] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own)).astype(bool)
        often = pairs[often]
        if not len(often):
            return none
        here = word[text[:-1]] << 32 | word[text[1:]]
        at = np.minimum(np.searchsorted(often, here), len(often) - 1)
        joined = np.append((often[at] == here) & (text[:-1] > 0) & (text[1:] > 0), False)
        text = _stretches(text, joined)
        if len(text) < 3:
            return none
        # Every pair in here is frequent, so extensions are checked by what is left of the text.
        index = PhraseIndex(text, len(word), LONGEST)
        three = index.extend(index.extend(index.words(), left=False), left=True)
        four = index.extend(three, left=False)
        parts = [np.column_stack([word[x.words], np.zeros((len(x.words), LONGEST - x.words.shape[1]), np.int64)]) for x in (three, four)]
        every = np.concatenate(parts)
        return pa.table(
            {
                "a": pa.array(every[:, 0] << 32 | every[:, 1]),
                "b": pa.array(every[:, 2] << 32 | every[:, 3]),
                "n": pa.array(np.concatenate([three.count, four.count])),
            }
        )

    return send


def frequent_phrases(docs: DataFrame, least: int = 30) -> tuple[DataFrame, DataFrame]:
    """(id, lang, word, f, n) of the frequent words, ``n`` being all words of the language; (words, f) of all frequent phrases of 1 to 4 words as ids."""
    split = tokens(docs)
    known, seed = dictionary(split)
    totals = known.groupBy("lang").agg(F.sum("f").alias("n"))
    placed = numbered(known.where(F.col("f") >= least), ["lang", "word"], "frequent-words")
    vocabulary = materialise(placed.select((F.col("place") + 1).alias("id"), "lang", "word", "hash", "f").join(totals, "lang"), "vocabulary")
    cut = shards(split, seed)
    asked = cut.select("shard", F.col("lang").alias("l"), F.posexplode("words").alias("place", "h"))
    ids = asked.join(vocabulary, (F.col("l") == F.col("lang")) & (F.col("h") == F.col("hash")))
    ids = materialise(ids.select("shard", (F.col("place") + 1).cast("long").alias("place"), "id"), "ids")

    words = known.agg(F.sum("f")).first()[0] or 0
    buckets = max(1, -(-words // BUCKET_PAIRS))
    # Numbers of shards in new columns: two sides of one cogroup must not share any.
    told = ids.select((F.col("shard") + 0).alias("to"), "place", "id")
    sent = cut.groupBy("shard").cogroup(told.groupBy("to")).applyInArrow(_send_pairs(buckets), PAIRS)
    answers = materialise(sent.groupBy("bucket").applyInArrow(_sum_pairs(least), ANSWERS), "pair-answers")
    bits = answers.where("bits IS NOT NULL").select((F.col("shard") + 0).alias("to"), "bucket", "bits")
    told = told.select("to", "place", "id", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("bits")).unionByName(
        bits.select("to", F.lit(None).cast("long").alias("place"), F.lit(None).cast("long").alias("id"), "bucket", "bits")
    )
    longer = cut.groupBy("shard").cogroup(told.groupBy("to")).applyInArrow(_send_longer(buckets), LONGER)
    longer = longer.groupBy("a", "b").agg(F.sum("n").alias("f")).where(F.col("f") >= least)

    def both(pair: str) -> list[Column]:
        return [F.shiftright(pair, 32), F.col(pair).bitwiseAND(F.lit((1 << 32) - 1))]

    phrases = (
        vocabulary.select(F.array("id").alias("words"), "f")
        .unionByName(answers.where("pair IS NOT NULL").select(F.array(*both("pair")).alias("words"), F.col("n").alias("f")))
        .unionByName(longer.select(F.filter(F.array(*both("a"), *both("b")), lambda w: w > 0).alias("words"), "f"))
    )
    return vocabulary, materialise(phrases, "phrases")


def scored(phrases: DataFrame, percent: int = 80) -> DataFrame:
    """(words, a, l, r, score) of the phrases that no longer one holds which is nearly as frequent.

    ``score`` is the lowest of all cuts into a first part of frequency ``l`` and a rest of ``r``; ties go to the shortest first part.
    """
    of_words = F.size("words")
    candidates = phrases.where(of_words > 1).select("words", F.col("f").alias("a"))
    cuts = candidates.select("words", "a", F.explode(F.sequence(F.lit(1), of_words - 1)).alias("k"))
    first = phrases.select(F.col("words").alias("first"), F.col("f").alias("l"))
    rest = phrases.select(F.col("words").alias("rest"), F.col("f").alias("r"))
    parts = cuts.select("words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("first"), F.slice("words", F.col("k") + 1, of_words - F.col("k")).alias("rest"))
    # Products may leave 64 bits, so they are decimals.
    score = F.expr("CAST(CAST(a AS DECIMAL(20, 0)) * 2000000BD DIV (CAST(l AS DECIMAL(20, 0)) + r) AS BIGINT)")
    cut = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    best = parts.join(first, "first").join(rest, "rest").groupBy("words").agg(F.first("a").alias("a"), cut)

    inner = F.explode(
        F.expr("flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), s -> slice(words, s, m))))")
    )
    inside = candidates.where(of_words > 2).select(F.col("a").alias("longer"), inner.alias("words")).groupBy("words").agg(F.max("longer").alias("longer"))
    near = F.expr(f"CAST(longer AS DECIMAL(20, 0)) * 100 >= CAST(a AS DECIMAL(20, 0)) * {int(percent)}")
    kept = best.join(inside, "words", "left").where(~F.coalesce(near, F.lit(False)))
    return kept.select("words", "a", "cut.l", "cut.r", "cut.score")


def ranked(phrases: DataFrame, vocabulary: DataFrame, top: int = 2000, percent: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by score, then frequency, then bytes of the phrase."""
    table = scored(phrases, percent)
    named = table.withColumn("id", F.get("words", F.lit(0))).join(vocabulary.select("id", "lang", "n"), "id")
    # All that may be among the best, ties included, before words are looked up.
    first = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
    best = materialise(named.withColumn("_first", first).where(F.col("_first") <= top).drop("_first", "id"), "best-phrases")
    each = best.select("words", F.posexplode("words").alias("at", "id")).join(vocabulary.select("id", "word"), "id")
    texts = each.groupBy("words").agg(F.array_join(F.sort_array(F.collect_list(F.struct("at", "word")))["word"], " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return best.join(texts, "words").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def digest(docs: DataFrame, least: int = 30, top: int = 2000) -> DataFrame:
    """The best phrases of every language."""
    vocabulary, phrases = frequent_phrases(docs, least)
    return ranked(phrases, vocabulary, top)
