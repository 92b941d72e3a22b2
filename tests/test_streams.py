from __future__ import annotations

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from oreflow.operators import bloom, messages
from oreflow.session import scratch_path
from oreflow.sources import files
from oreflow.streaming.bloom import BloomStream, sequenced
from oreflow.streaming.reservoir import ReservoirStream
from oreflow.streaming.state import VersionedTable


def tag_hash(text):
    h = 0
    for c in text:
        h = (h * 31 + ord(c)) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


class SequentialFilter:
    """The filter, one arrival at a time."""

    def __init__(self, exact):
        self.bits, self.known, self.exact = [0] * 64, set(), exact
        self.wrong = 0

    def run(self, tags):
        correct = wrong = 0
        for tag in tags:
            h = tag_hash(tag)
            a, b = abs(h) % 64, abs(h) % 59
            key = h if self.exact == "hash" else tag
            if not (self.bits[a] and self.bits[b]):
                self.bits[a] = self.bits[b] = 1
                correct += 1
            elif key in self.known:
                correct += 1
            else:
                wrong += 1
            self.known.add(key)
        self.wrong += wrong
        return correct, wrong, len(self.known), self.wrong


def random_tags(rng, n):
    words = ["Aa", "BB", "", "AaAa", "BBBB"] + [f"t{rng.randint(0, 500)}" for _ in range(rng.randint(5, 120))]
    return [rng.choice(words) for _ in range(n)]


@pytest.mark.parametrize("exact", ["hash", "tag"])
def test_batch_reports_equal_the_sequential_filter(spark, exact):
    rng = random.Random(7)
    for _ in range(4):
        tags = random_tags(rng, 300)
        width = rng.randint(20, 90)
        df = spark.createDataFrame(list(enumerate(tags)), "seq bigint, tag string").repartition(3)
        got = bloom.batch_report(df, F.floor(F.col("seq") / width).cast("bigint"), exact_key=exact).orderBy("batch")
        filter_ = SequentialFilter(exact)
        expected = [filter_.run(tags[i : i + width]) for i in range(0, len(tags), width)]
        assert [tuple(r)[1:] for r in got.collect()] == expected
        whole = bloom.summary(df, exact_key=exact).first()
        assert (whole["arrivals"], whole["incorrect"], whole["unique_tags"]) == (300, filter_.wrong, len(filter_.known))


def test_running_totals_over_many_blocks(spark):
    rng = random.Random(8)
    rows = [(i * 3 + 5, rng.randint(0, 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "at bigint, x bigint").repartition(4)
    got = {r["at"]: r["total_x"] for r in bloom.running_totals(df, "at", ["x"], blocks=7).collect()}
    total = 0
    for at, x in rows:
        total += x
        assert got[at] == total


def test_large_filters_are_joined(spark, monkeypatch):
    tags = random_tags(random.Random(3), 200)
    df = spark.createDataFrame(list(enumerate(tags)), "seq bigint, tag string")
    small = sorted(map(tuple, bloom.false_positives(df, (64, 59)).collect()))
    monkeypatch.setattr(bloom, "BROADCAST_SLOTS", 1)
    assert sorted(map(tuple, bloom.false_positives(df, (64, 59)).collect())) == small
    assert bloom.false_positives(df, (1 << 30, 3)).count() == len(small)
    with pytest.raises(ValueError):
        bloom.false_positives(df, exact_key="text")


def write_file(folder, number, rows):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/m{number:03d}.json"
    with open(path, "w") as out:
        for i, text in rows:
            out.write(json.dumps({"id": i, "ts": "2024-01-01T00:00:00Z", "text": text}) + "\n")
    stamp = time.time() - 1000 + number * 10
    os.utime(path, (stamp, stamp))


def make_messages(seed, n):
    rng = random.Random(seed)
    tags = ["Aa", "BB"] + [f"w{i}" for i in range(60)]
    return [(i, f"m {rng.choice('xyz')}\n#{rng.choice(tags)}#{rng.choice(tags)} #{rng.choice(tags)} end") for i in range(n)]


@pytest.mark.parametrize("exact", ["hash", "tag"])
def test_bloom_stream_equals_the_sequential_filter_across_a_restart(spark, exact):
    rows = make_messages(9, 90)
    folder, state = scratch_path(spark, "in"), scratch_path(spark, "state")
    filter_ = SequentialFilter(exact)
    expected = []
    for number, first in enumerate(range(0, 90, 15)):
        part = rows[first : first + 15]
        write_file(folder, number, part)
        expected.append(filter_.run([t for _, text in part for t in text.split("#")[1:] for t in [t.split(" ")[0]]]))
        if number in (2, 5):  # the stream runs twice, the second time from its checkpoint
            stream = BloomStream(state, exact_key=exact)
            source = files.stream_messages(spark, folder, files_per_batch=1)
            stream.start(source, until_done=True).awaitTermination()
    got = stream.reports.history(spark).orderBy("batch_id").collect()
    assert [tuple(r)[:4] for r in got] == expected


def test_reservoir_stream_equals_the_sample_of_everything(spark):
    rows = make_messages(10, 300)
    folder, state = scratch_path(spark, "in"), scratch_path(spark, "state")
    for number, first in enumerate(range(0, 300, 60)):
        write_file(folder, number, rows[first : first + 60])
    stream = ReservoirStream(state, k=40)
    stream.start(files.stream_messages(spark, folder, files_per_batch=2), until_done=True).awaitTermination()
    reports = stream.reports.history(spark).orderBy("batch_id").collect()
    assert [r["seen"] for r in reports] == [120, 240, 300]

    every = spark.createDataFrame(rows, "id bigint, text string")
    sample = messages.bottom_k(every, 40)
    kept = stream.sample.read(spark, 2)
    assert {r["id"] for r in kept.collect()} == {r["id"] for r in sample.collect()}
    assert tuple(messages.sample_report(sample, 300).first()) == tuple(reports[-1])[:3]

    # A batch that runs again replaces its own result.
    stream.run_batch(every.filter("id >= 240"), 2)
    assert stream.sample.read(spark, 2).first()["seen"] == 300


def test_sample_is_uniform_enough(spark):
    hits = [0] * 10
    df = spark.range(1000).selectExpr("id", "'x' as text")
    for seed in range(5):
        for row in messages.bottom_k(df, 200, seed).collect():
            hits[row["id"] // 100] += 1
    assert all(60 <= h <= 140 for h in hits)


def test_hot_tags_break_ties_by_name(spark):
    df = spark.createDataFrame([(1, "#b #a #b"), (2, "#c #a x")], "id bigint, text string")
    assert [tuple(r) for r in messages.hot_tags(df, 2).collect()] == [("a", 2), ("b", 2)]
    report = messages.sample_report(df, 7).first()
    assert tuple(report) == (7, "a:2,b:2,c:1", 7.5)


def test_empty_sample_report(spark):
    df = spark.createDataFrame([], "id bigint, text string")
    assert tuple(messages.sample_report(df, 0).first()) == (0, "", None)


def test_sequence_follows_messages_and_places(spark):
    large = 9_000_000_000_000_000_000
    df = spark.createDataFrame([(large + 3, "#x#y"), (large + 1, "a #z")], "id bigint, text string")
    rows = [(r["seq"]["id"] - large, r["seq"]["position"], r["tag"]) for r in sequenced(df).orderBy("seq").collect()]
    assert rows == [(1, 1, "z"), (3, 1, "x"), (3, 2, "y")]


def test_state_does_not_grow_with_the_batches(spark):
    table = VersionedTable(scratch_path(spark, "state"), "x int", keep=3)
    for batch in range(7):
        table.write(spark.createDataFrame([(batch,)], "x int"), batch)
        assert table.read(spark, batch).first()["x"] == batch
    assert len(os.listdir(table.folder)) == 3
    with pytest.raises(ValueError):
        table.history(spark)
