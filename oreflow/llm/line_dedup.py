"""Removal of lines that many documents share, by levelled sorted runs of line hashes.

Documents arrive in batches. A batch counts, per line key, the documents that hold it, leaves
out the keys already known as frequent (anti-join), and adds the rest as a sorted run of level
0. ``fan_in`` runs of one level are compacted into one run of the next: counts are summed, keys
that reach the threshold move to the frequent keys, the others stay.

A key is the line with white space stripped at both ends and A-Z lower-cased; it is carried as
two 64-bit hashes. A null or empty text is one empty line. Empty keys are never frequent. Rows
that repeat an id and a text are one document when documents are counted; each row still gets
its result. A null id is an id like any other. An empty table gives an empty result.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm.common import SPACES, ascii_lower, documents_only, free_name, two_hashes
from oreflow.session import materialise

KEY = ["h1", "h2"]
RUN = "h1 long, h2 long, n_docs long"


class LineRuns:
    """Document counts of line keys over all batches added so far."""

    def __init__(self, spark: SparkSession, threshold: int = 10, fan_in: int = 4):
        self.threshold, self.fan_in = threshold, fan_in
        self.levels: list[list[DataFrame]] = [[]]
        self.frequent = spark.createDataFrame([], "h1 long, h2 long")

    def _stored(self, counts: DataFrame, label: str) -> DataFrame:
        return materialise(counts.sortWithinPartitions(*KEY), label)

    def add(self, lines: DataFrame) -> None:
        """Adds a batch of (doc_id, version, h1, h2), one row per line, as its own run."""
        fresh = (
            lines.select("doc_id", "version", *KEY)
            .distinct()
            .groupBy(*KEY)
            .agg(F.count("*").alias("n_docs"))
            .join(self.frequent, KEY, "left_anti")
        )
        self.levels[0].append(self._stored(fresh, "line-run"))
        self._compact(self.fan_in)

    def _compact(self, at_least: int) -> None:
        for level, runs in enumerate(self.levels):
            if len(runs) >= at_least:
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level] = []
                self.levels[level + 1].append(self._merge(runs, level))

    def _merge(self, runs: list[DataFrame], level: int) -> DataFrame:
        """One run of the summed counts; keys at the threshold leave it for the frequent keys."""
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.unionByName(run)
        merged = self._stored(rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs")), f"line-run-{level + 1}")
        reached = merged.where(F.col("n_docs") >= self.threshold).select(*KEY)
        self.frequent = materialise(self.frequent.unionByName(reached).distinct(), "line-frequent")
        return merged.where(F.col("n_docs") < self.threshold)

    def frequent_keys(self) -> DataFrame:
        """(h1, h2) of every key that reaches the threshold, after one last compaction of all runs."""
        runs = [run for level in self.levels for run in level]
        if runs:
            self.levels = [[] for _ in self.levels] + [[]]
            self.levels[-1].append(self._merge(runs, len(self.levels)))
        return self.frequent


def line_key(line: Column) -> Column:
    """The line stripped of white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_rows(docs: DataFrame, batches: int) -> DataFrame:
    """(doc_id, version, batch, pos, h1, h2): one row per line; the hashes of an empty key are null."""
    rows = documents_only(docs).select("doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = rows.select("doc_id", "version", "pos", line_key(F.col("line")).alias("key"))
    filled = F.col("key") != ""
    h1, h2 = two_hashes(F.col("key"))
    return keys.select(
        "doc_id",
        "version",
        F.pmod(F.xxhash64("doc_id", "version"), F.lit(batches).cast("long")).cast("int").alias("batch"),
        "pos",
        F.when(filled, h1).alias("h1"),
        F.when(filled, h2).alias("h2"),
    )


def drop_marks(docs: DataFrame, threshold: int = 10, batches: int = 4, fan_in: int = 4) -> DataFrame:
    """(doc_id, version, drops): for each line of each document, in order, whether it goes."""
    lines = materialise(line_rows(docs, batches), "lines")
    runs = LineRuns(docs.sparkSession, threshold, fan_in)
    for batch in range(batches):
        runs.add(lines.where((F.col("batch") == batch) & F.col("h1").isNotNull()))
    frequent = runs.frequent_keys().withColumn("drop", F.lit(True))
    marked = lines.join(frequent, KEY, "left").select(
        "doc_id", "version", F.struct("pos", F.coalesce("drop", F.lit(False)).alias("drop")).alias("mark")
    )
    return marked.groupBy("doc_id", "version").agg(F.sort_array(F.collect_set("mark"))["drop"].alias("drops"))


def remove_frequent_lines(docs: DataFrame, threshold: int = 10, batches: int = 4, fan_in: int = 4) -> DataFrame:
    """``docs`` without the lines whose key occurs in at least ``threshold`` documents.

    All columns stay; ``text`` holds the lines that are left (null if it was null), and ``n_lines`` and ``n_dropped`` are added under these names, or with underscores
    before them where the input has such columns.
    """
    n_lines, n_dropped = free_name(docs.columns, "n_lines"), free_name(docs.columns, "n_dropped")
    marks = drop_marks(docs, threshold, batches, fan_in).select(F.struct("doc_id", "version", "drops").alias("found"))
    # One struct for the input and one for the marks: no column of the input can clash.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    joined = rows.join(
        marks, F.col("row.doc_id").cast("long").eqNullSafe(F.col("found.doc_id")) & (F.xxhash64(text) == F.col("found.version")), "left"
    )
    lines = joined.select("row", F.split(text, "\n").alias("lines"), F.col("found.drops").alias("drops"))
    kept = F.filter("lines", lambda _, i: ~F.get(F.col("drops"), i))
    return lines.select(
        *(
            (F.when(F.col("row.text").isNotNull(), F.concat_ws("\n", kept)).alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c))
            for c in docs.columns
        ),
        F.size("lines").cast("long").alias(n_lines),
        F.size(F.filter("drops", lambda drop: drop)).cast("long").alias(n_dropped),
    )


def digest(docs: DataFrame, threshold: int = 10) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    plain = documents_only(docs)
    return remove_frequent_lines(plain, threshold).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
