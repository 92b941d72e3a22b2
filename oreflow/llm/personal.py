"""Personal data: base patterns, and boosted trees that judge what wider patterns propose.

Base spans (e-mail and IP addresses, card and phone numbers) follow from fixed patterns with fixed
checks. Generators of high recall propose more spans, which overlap each other and the base ones: numbers
without a plus sign, cards with other separators, addresses with written-out signs, longer forms.
Gradient-boosted trees judge each proposal by its format and its context. What labels a proposal is
kept from them: they see neither plus signs nor check digits. A proposal is labelled 1 where it lies on
a base span of its kind, 0 where on a base span of another kind or on one of its kind that failed its
check. All distinct ones count, next to a few fixed ones; a quarter of them, by hash, is held out, and those of
one description are one row for the trees, weighed by their number. Isotonic calibration on the held-out part turns scores into
probabilities, and from ``SURE`` on an unlabelled proposal becomes a span, one per overlapping group. A kind
of which nothing is held out gets no further spans, as nothing proves its scores right.
Base spans always stay.

Starts and ends count code points. Texts are first cut to the runs of words with digits or ``@``
(no base span crosses their ends); patterns scan possessively, so that very long texts, words and
numbers take time in proportion. A null or empty text has no spans. Rows are judged one by one, so
repeated rows get equal results and null ids are kept; an empty table gives an empty result. Only
``doc_id`` and ``text`` are read, other columns may have any names; :func:`clean` keeps them.

Only DataFrame functions and the JVM's boosted trees are used.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreflow.llm.common import documents_only, free_name
from oreflow.session import materialise

# The kinds in the order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone")
# Calibrated probability from which on a proposal becomes a span.
SURE = 0.9

# Words with a digit or an @, and what punctuation and spaces stand between them.
REGION = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?: ++(?:[().\-]++ ++)*+[^\s0-9@]*+[0-9@]\S*+)*+"
# The base patterns, written so that no start inside a run is tried twice.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+\-]))[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ \-]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9\-]+[0-9]",
}
SMALL_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# The generators: name, kind and pattern.
WIDE = [
    ("any_address", "email", r"(?<![^\s@<>()\[\],;:\"'|])[^\s@<>()\[\],;:\"'|]++@[^\s@<>()\[\],;:\"'|]++"),
    ("long_address", "ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    ("bracketed_address", "ip", r"(?<![0-9])[0-9]{1,3}(?:\[?\.\]?[0-9]{1,3}){3}(?![0-9])"),
    ("four_digits", "card", r"(?<![0-9])[0-9]{4}(?:[ ./_\-]{1,2}[0-9]{2,6}){2,3}(?:[ ./_\-]{1,2}[0-9]{1,3})?(?![0-9])"),
    ("long_number", "card", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("number_in_groups", "phone", r"(?<![0-9])[0-9](?:[ ().\-/]{0,2}[0-9])++"),
    ("bracketed_code", "phone", r"\([0-9]{2,5}\)[ .\-]{0,2}[0-9]{2,5}(?:[ .\-][0-9]{2,5}){1,3}(?![0-9])"),
    ("three_groups", "phone", r"(?<![0-9])[0-9]{2,4}[ .\-/][0-9]{3,4}[ .\-][0-9]{3,4}(?![0-9])"),
]
# Addresses with written-out signs, looked for in texts that hold a bracketed "at".
WRITTEN_AT = r"(?i)[\[({] ?at ?[\])}]"
WRITTEN = (
    r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++ ?[\[({] ?(?i:at) ?[\])}] ?[A-Za-z0-9\-]++(?:(?:\.| ?[\[({] ?(?i:dot) ?[\])}] ?)[A-Za-z0-9\-]++)++"
)
# Words before a number that tell what it is.
CONTACT = r"(?i)(?:tel|telephone|phone|fone|call|fax|mobile|cell|sms|whatsapp|contact|ring|dial|mail|write|reach)\.?[ :=]*\+?$"
PAYMENT = r"(?i)(?:card|visa|mastercard|amex|credit|debit|payment|pan)\.?[ :=#]*$"
MACHINE = r"(?i)(?:ip|host|server|address|addr|client|from|ping)\.?[ :=]*$"
OTHER = r"(?i)(?:order|invoice|isbn|issn|version|v|build|release|section|chapter|figure|part|serial|sku|id|no|nr|page|commit|score|ratio|total|date|year|doi|case|ticket|release)\.?[ :=#]*$"

# Fixed findings that the trees always see: kind, text before, proposal, text after, label.
FIXED = [
    ("phone", "call ", "(487) 555-7209", " now", 1),
    ("phone", "Tel: ", "030 555 0143", "\n", 1),
    ("phone", "phone ", "415-555-0132", ".", 1),
    ("phone", "fax: ", "(030) 5550-143", "", 1),
    ("phone", "or ", "(974) 555-3436", " that", 1),
    ("phone", "mobile ", "0171 555 2028", "", 1),
    ("phone", "order ", "415 555 0132", " was", 0),
    ("phone", "ISBN ", "978-0-306-40615-7", ",", 0),
    ("phone", "on ", "2024-05-17", " at", 0),
    ("phone", "sum ", "1000 2000 3000", " of", 0),
    ("phone", "version ", "10.15.7", "", 0),
    ("phone", "pages ", "112-118", " and", 0),
    ("phone", "number ", "4929348385146306", " eaur", 0),
    ("phone", "id ", "20260101123045", "", 0),
    ("email", "mail ", "jane (at) example (dot) org", " for", 1),
    ("email", "write to ", "a.b [at] mail.example.com", ".", 1),
    ("email", "from ", "josé@correo.example.es", " to", 1),
    ("email", "contact: ", "x1@mail5.example.com", "", 1),
    ("email", "the ", "@decorator", " of", 0),
    ("email", "at ", "3@4", " each", 0),
    ("email", "", "user@host", " $", 0),
    ("email", "price ", "5@2.50", " each", 0),
    ("email", "met ", "us (at) noon.then", " we", 0),
    ("ip", "host ", "10[.]0[.]23[.]7", " down", 1),
    ("ip", "from ", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "", 1),
    ("ip", "to ", "192.168.20[.]14", ".", 1),
    ("ip", "version ", "10.2.33.1", " of", 0),
    ("ip", "section ", "1.2.3.4", "", 0),
    ("ip", "at ", "12:30:45:10:20:30:40:50", "", 0),
    ("card", "card ", "4111.1111.1111.1111", " and", 1),
    ("card", "visa: ", "4000/0566/5566/5556", "", 1),
    ("card", "pay with ", "5105  1051  0510  5100", ".", 1),
    ("card", "from ", "1990/1991/1992/1993", " on", 0),
    ("card", "order ", "1234.5678.9012.3456", "", 0),
    ("card", "serial ", "1234567890123", "", 0),
    ("card", "at ", "2024-05-17 1030 2024", "", 0),
]


def _matches(rows: DataFrame, keys: list[str], text: str, patterns: list[tuple[str, str, str]]) -> DataFrame:
    """(keys, gen, kind, nth, gap, value, before, after) of every match; ``head`` and ``tail`` are what surrounds the text."""
    found = F.array(
        *(
            F.struct(
                F.lit(name).alias("gen"),
                F.lit(kind).alias("kind"),
                F.split(text, pattern, -1).alias("parts"),
                F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"),
            )
            for name, kind, pattern in patterns
        )
    )
    each = rows.select(*keys, "head", "tail", F.explode(found).alias("f")).select(*keys, "head", "tail", "f.*").where(F.size("values") > 0)

    def around(value: Column, i: Column) -> Column:
        gap, following = F.get("parts", i), F.get("parts", i + 1)
        last = F.coalesce(F.get("values", i + 1), F.col("tail"))
        return F.struct(
            i.alias("nth"),
            F.length(gap).cast("long").alias("gap"),
            value.alias("value"),
            F.right(F.concat(F.when(i == 0, F.col("head")).otherwise(F.right(F.get("values", F.greatest(i - 1, F.lit(0))), F.lit(48))), gap), F.lit(48)).alias("before"),
            F.left(F.concat(F.left(following, F.lit(32)), F.left(last, F.lit(32))), F.lit(32)).alias("after"),
        )

    return each.select(*keys, "gen", "kind", F.explode(F.transform("values", around)).alias("m")).select(*keys, "gen", "kind", "m.*")


def _placed(found: DataFrame, keys: list[str]) -> DataFrame:
    """``found`` with ``start``, the place of each match in its text, as a running sum along the matches of one pattern."""
    order = Window.partitionBy(*keys, "gen").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("value").cast("long")
    return found.withColumn("start", F.sum(F.col("gap") + size).over(order) - size).drop("gap", "nth")


def _luhn(digits: Column) -> Column:
    """True where the sum of the digits, every second from the right doubled, is a multiple of ten."""
    last_first = F.split(F.reverse(digits), "")

    def weighed(digit: Column, i: Column) -> Column:
        d = digit.cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(last_first, weighed), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid() -> Column:
    """Whether a match of a base pattern passes its kind's check."""
    digits = F.regexp_replace("value", "[^0-9]", "")
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", F.col("value").rlike(rf"^{SMALL_PART}(?:\.{SMALL_PART}){{3}}$"))
        .when(F.col("kind") == "phone", F.length(digits).between(10, 15))
        .when(F.length(digits).between(14, 19), _luhn(digits))
        .otherwise(False)
    )


def _plausible() -> Column:
    """Proposals that no reader would take for their kind are not judged at all."""
    digits = F.regexp_replace("value", "[^0-9]", "")
    return (
        F.when(F.col("kind") == "phone", F.length(digits).between(7, 15))
        .when(F.col("kind") == "card", F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False))
        .otherwise(F.length("value") <= 320)
    )


def proposals(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of every row, and (row, gen, kind, start, end, value, before, after, base, valid) of every match.

    ``row`` numbers the rows of ``docs``; both tables come from one stored scan of the texts.
    """
    texts = documents_only(docs).withColumn("row", F.monotonically_increasing_id())
    gaps, values = F.split("text", REGION, -1), F.regexp_extract_all("text", F.lit(REGION), F.lit(0))
    written = F.when(F.col("text").rlike(WRITTEN_AT), F.col("text"))
    cut = texts.select("row", "doc_id", gaps.alias("parts"), values.alias("values"), written.alias("written"))
    regions = F.transform(
        "values",
        lambda value, i: F.struct(
            i.alias("nth"),
            F.length(F.get("parts", i)).cast("long").alias("gap"),
            value.alias("value"),
            F.right(F.get("parts", i), F.lit(48)).alias("head"),
            F.left(F.get("parts", i + 1), F.lit(32)).alias("tail"),
        ),
    )
    # Every row keeps at least one line, so the table holds the rows without regions, too.
    stored = materialise(
        cut.select("row", "doc_id", "written", F.explode_outer(regions).alias("m")).select(
            "row", "doc_id", F.when(F.coalesce(F.col("m.nth"), F.lit(0)) == 0, F.col("written")).alias("written"), "m.*"
        ),
        "regions",
    )
    rows = stored.where("nth IS NULL OR nth = 0").select("row", "doc_id")
    placed = _placed(stored.where("nth IS NOT NULL").withColumn("gen", F.lit("region")).withColumn("first", F.col("nth")), ["row"])
    patterns = [(f"base_{kind}", kind, BASE[kind]) for kind in KINDS] + WIDE
    inside = _matches(placed.withColumnRenamed("start", "offset"), ["row", "first", "offset"], "value", patterns)
    inside = _placed(inside, ["row", "first"]).withColumn("start", F.col("start") + F.col("offset")).drop("first", "offset")
    whole = stored.where("written IS NOT NULL").select("row", "written", F.lit("").alias("head"), F.lit("").alias("tail"))
    spelled = _placed(_matches(whole, ["row"], "written", [("written_address", "email", WRITTEN)]), ["row"])
    every = inside.unionByName(spelled)
    is_base = F.startswith("gen", F.lit("base_"))
    every = every.withColumns({"end": F.col("start") + F.length("value"), "base": is_base, "valid": F.when(is_base, _valid()).otherwise(_plausible())})
    return rows, materialise(every.where("base OR valid"), "matches")


def _overlaps(found: DataFrame) -> DataFrame:
    """Proposals with ``own``, ``failed`` and ``other``: whether they overlap a base span of their kind, a failed one of it, a base span of another kind.

    A running maximum of the ends of base matches that start before a proposal ends, so that no pairs are formed.
    """
    # At one place proposals come first: a base match that starts where a proposal ends does not overlap it.
    point = F.when(F.col("base"), F.col("start")).otherwise(F.col("end"))
    before = Window.partitionBy("row").orderBy("point", "base").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def reach(kind: str, valid: bool) -> Column:
        return F.max(F.when(F.col("base") & (F.col("kind") == kind) & (F.col("valid") == valid), F.col("end"))).over(before)

    marked = found.withColumn("point", point).select(
        "*", *(reach(kind, True).alias(f"_in_{kind}") for kind in KINDS), *(reach(kind, False).alias(f"_near_{kind}") for kind in KINDS)
    )

    def meets(prefix: str, own: bool) -> Column:
        tests = [(F.col("kind") == kind if own else F.col("kind") != kind) & F.coalesce(F.col(f"{prefix}_{kind}") > F.col("start"), F.lit(False)) for kind in KINDS]
        return tests[0] | tests[1] | tests[2] | tests[3]

    return marked.where("NOT base").select(
        *found.columns, meets("_in", True).alias("own"), meets("_near", True).alias("failed"), meets("_in", False).alias("other")
    )


def features(found: DataFrame) -> DataFrame:
    """``found`` with a column per feature of format and context; none tells of plus signs or check digits."""
    value, before, after = F.col("value"), F.regexp_replace("before", r"\+$", ""), F.col("after")
    groups = F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))
    sizes = F.transform(groups, lambda g: F.length(g))
    host = F.regexp_extract(value, r"([A-Za-z0-9.\-]+)$", 1)

    def count(characters: str) -> Column:
        return F.regexp_count(value, F.lit(characters)).cast("double")

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("double")

    numbers = {
        "f_length": F.length(value).cast("double"),
        "f_digits": count("[0-9]"),
        "f_letters": count(r"\p{L}"),
        "f_groups": F.size(groups).cast("double"),
        "f_first_group": F.coalesce(F.get(sizes, F.lit(0)), F.lit(0)).cast("double"),
        "f_last_group": F.coalesce(F.try_element_at(sizes, F.lit(-1)), F.lit(0)).cast("double"),
        "f_largest_group": F.coalesce(F.array_max(sizes), F.lit(0)).cast("double"),
        "f_smallest_group": F.coalesce(F.array_min(sizes), F.lit(0)).cast("double"),
        "f_spaces": count(" "),
        "f_dots": count(r"\."),
        "f_hyphens": count("-"),
        "f_slashes": count("[/_]"),
        "f_brackets": count(r"[()\[\]{}]"),
        "f_colons": count(":"),
        "f_host_labels": F.regexp_count(host, F.lit(r"\.")).cast("double") + 1,
        "f_last_label": F.length(F.regexp_extract(host, r"([A-Za-z]*)$", 1)).cast("double"),
        "f_year": flag(value.rlike(r"(?:^|[^0-9])(?:19|20)[0-9]{2}(?:[^0-9]|$)")),
        "f_contact": flag(before.rlike(CONTACT)),
        "f_payment": flag(before.rlike(PAYMENT)),
        "f_machine": flag(before.rlike(MACHINE)),
        "f_other": flag(before.rlike(OTHER)),
        "f_word_before": flag(before.rlike(r"\p{L}[ ]?$")),
        "f_glued_before": flag(before.rlike(r"[\p{L}0-9_/.:=]$")),
        "f_glued_after": flag(after.rlike(r"^[\p{L}0-9_/]")),
        "f_money": flag(before.rlike(r"[$€£#][ ]?$") | after.rlike(r"^ ?(?:%|€|[A-Z]{3}\b)")),
    }
    return found.withColumns(numbers | {f"f_is_{kind}": flag(F.col("kind") == kind) for kind in KINDS})


def calibrate(bins: list[tuple[int, int, int]], sure: float = SURE) -> float:
    """The least score from which on the probability is at least ``sure``, by isotonic regression.

    ``bins`` holds (score in hundredths, ones, zeros) of held-out proposals. One zero at score 0 and one one at 1
    stand for what is known without any.
    """
    counts = {0: [0, 1], 100: [1, 0]}
    for score, ones, zeros in bins:
        cell = counts.setdefault(score, [0, 0])
        cell[0] += ones
        cell[1] += zeros
    pooled: list[list[float]] = []  # least score, ones, all
    for score in sorted(counts):
        ones, zeros = counts[score]
        pooled.append([score, ones, ones + zeros])
        while len(pooled) > 1 and pooled[-2][1] * pooled[-1][2] >= pooled[-1][1] * pooled[-2][2]:
            _, ones, n = pooled.pop()
            pooled[-1][1] += ones
            pooled[-1][2] += n
    good = [score for score, ones, n in pooled if ones >= sure * n]
    return min(good) / 100 if good else 2.0


def _labelled(spark: SparkSession, described: DataFrame, findings: DataFrame | None) -> DataFrame:
    """(kind, label, held, features, n): every distinct labelled proposal, counted by its description."""
    label = F.when(F.col("own"), 1).when(F.col("other") | F.col("failed"), 0)
    names = [c for c in described.columns if c.startswith("f_")]
    what = ["kind", "before", "value", "after"]
    if findings is None:
        rows = described.withColumn("label", label).where("label IS NOT NULL").select(*what, "label", *names).dropDuplicates(what)
    else:
        given = findings.select(*what, F.col("label").cast("int")).where("label IS NOT NULL AND value IS NOT NULL")
        rows = features(given).select(*what, "label", *names)
    rows = rows.withColumn("held", F.pmod(F.xxhash64(*what), F.lit(4)) == 0)
    fixed = features(spark.createDataFrame(FIXED, "kind string, before string, value string, after string, label int"))
    every = rows.unionByName(fixed.withColumn("held", F.lit(False)))
    counted = every.groupBy("kind", "label", "held", *names).agg(F.count("*").alias("n"))
    return materialise(counted.withColumn("label", F.col("label").cast("double")), "labelled")


def judge(found: DataFrame, findings: DataFrame | None = None, trees: int = 20, seed: int = 7) -> DataFrame:
    """Proposals of ``found`` with ``own``, ``failed``, ``other``, ``score`` and whether they are ``chosen``.

    ``findings`` are labelled findings (kind, before, value, after, label) to learn from in place of the corpus's own.
    """
    spark = found.sparkSession
    described = materialise(features(_overlaps(found)), "proposals")
    names = [c for c in described.columns if c.startswith("f_")]
    labelled = _labelled(spark, described, findings)
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    # Each kind and label weighs the same, so that what a corpus holds most of does not decide.
    cells = labelled.where("NOT held").groupBy("kind", "label").agg((F.lit(100.0) / F.sum("n")).alias("weight"))
    training = labelled.where("NOT held").join(F.broadcast(cells), ["kind", "label"]).withColumn("weight", F.col("weight") * F.col("n"))
    model = GBTClassifier(maxIter=trees, maxDepth=4, stepSize=0.2, seed=seed, weightCol="weight").fit(assembler.transform(training))

    def scored(rows: DataFrame) -> DataFrame:
        return model.transform(assembler.transform(rows)).withColumn("score", vector_to_array("probability")[1])

    held = scored(labelled.where("held")).groupBy("kind", F.floor(F.col("score") * 100).cast("int").alias("bin"))
    bins = held.agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("ones"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("zeros")).collect()
    least = F.lit(2.0)
    for kind in KINDS:
        threshold = calibrate([(b["bin"], b["ones"], b["zeros"]) for b in bins if b["kind"] == kind])
        least = F.when(F.col("kind") == kind, threshold).otherwise(least)
    unknown = ~(F.col("own") | F.col("failed") | F.col("other"))
    return scored(described).select(*found.columns, "own", "failed", "other", "score", (unknown & (F.col("score") >= least)).alias("chosen"))


def _merged(chosen: DataFrame) -> DataFrame:
    """One span (row, kind, start, end) for each group of overlapping ones of a kind."""
    order = Window.partitionBy("row", "kind").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = chosen.withColumn("fresh", F.when(F.col("start") < reach, 0).otherwise(1))
    numbered = fresh.withColumn("group", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("row", "kind", "group").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("group")


def _spans(rows: DataFrame, found: DataFrame, findings: DataFrame | None) -> DataFrame:
    """(row, doc_id, spans) of every row: its spans (start, rank of the kind, end, base) in order."""
    base = found.where("base AND valid").select("row", "kind", "start", "end", F.lit(True).alias("base"))
    added = _merged(judge(found, findings).where("chosen")).withColumn("base", F.lit(False))
    rank = F.array_position(F.array(*(F.lit(kind) for kind in KINDS)), F.col("kind")).cast("int")
    spans = base.unionByName(added).select("row", F.lit(None).cast("long").alias("doc_id"), F.struct("start", rank.alias("kind"), "end", "base").alias("span"))
    none = F.lit(None).cast(spans.schema["span"].dataType)
    every = rows.select("row", "doc_id", none.alias("span")).unionByName(spans)
    return every.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sort_array(F.collect_list("span")).alias("spans"))


def find(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """(doc_id, spans) of every row: spans (start, kind, end, base) in order, ``kind`` as its place in ``KINDS`` from 1 on."""
    return _spans(*proposals(docs), findings).select("doc_id", "spans")


def clean(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind, as in ``[EMAIL]``; a null text stays null."""
    name = free_name(docs.columns, "row_number")
    kept = materialise(docs.withColumn(name, F.monotonically_increasing_id()), "kept")
    marked = find(kept.select(F.col(f"`{name}`").alias("doc_id"), "text"), findings).select(F.col("doc_id").alias("_to"), F.col("spans").alias("_spans"))
    ends = F.col("_spans.end")
    # What lies before each span that no earlier span reaches into, then its kind; last the rest.
    furthest = F.transform("_spans", lambda s, i: F.coalesce(F.array_max(F.slice(ends, F.lit(1), i)), F.lit(0)))
    labels = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))
    pieces = F.transform(
        F.arrays_zip(F.col("_spans").alias("s"), furthest.alias("done")),
        lambda x: F.when(
            x["s"]["start"] >= x["done"],
            F.concat(F.substr(F.col("text"), (x["done"] + 1).cast("int"), (x["s"]["start"] - x["done"]).cast("int")), F.element_at(labels, x["s"]["kind"])),
        ).otherwise(F.lit("")),
    )
    rest = F.substr(F.col("text"), (F.coalesce(F.array_max(ends), F.lit(0)) + 1).cast("int"), F.length("text"))
    text = F.when(F.size("_spans") > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col("text"))
    joined = kept.join(marked, F.col(f"`{name}`") == F.col("_to"), "left")
    return joined.select(*(text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns))


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row; the numbers count base spans."""
    kinds = F.array(*(F.lit(kind) for kind in KINDS))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"]), s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS, 1)]
    return find(docs).select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
