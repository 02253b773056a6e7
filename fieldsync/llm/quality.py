r"""Quality rules: base rules of a document, and cross-document line frequency per host.

Words are `[^\x20\x09-\x0D]+`, lines are cut at \n. The base rules reject a document of fewer than
`LEAST_WORDS` words, or one of whose words more than `REPEATED` percent stand in windows of eight words that
the document holds twice or more.

Lines with a word are normalised (lower case, words joined by one space) and hashed. For each host the
documents that hold a line are counted. Documents with the same set of lines count once, in the line's count
and in the host's, so that copies don't make their own lines boilerplate; sets are compared whole. A line in at
least `LINE_DOCUMENTS` documents and `LINE_SHARE` percent of its host's is removed from the text; a document
that keeps less than `LEFT` percent of its words is depleted and rejected. Blank lines stay, and so does a text
without such a line, as it is.

Built from DataFrame functions only. The rules of a document need no shuffle; copies are
dropped by a hash aggregate, lines counted in two steps, so a line that all documents hold is spread over tasks.
A host has at most 100 / `LINE_SHARE` times as many frequent lines as its documents have on average. They are gathered
per host, counted, and broadcast if there are no more than `GATHERED`, so that texts stay where they are; else the places of frequent
lines are joined to the texts.

A null or empty text has no words and fails. A null host is the host ''. Rows that repeat a `doc_id` are
told apart by the MD5 of their text; equal rows share a verdict and count once. A null `doc_id` is a value
like others. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsync.sources.staging import stage

WINDOW = 8
#: Fewer words fail; so does a greater percentage of words in repeated windows.
LEAST_WORDS, REPEATED = 20, 30
#: Documents of a host, and percentage of them, from which a line is removed; percentage of words that must be left.
LINE_DOCUMENTS, LINE_SHARE, LEFT = 10, 1, 30
#: Frequent lines that are broadcast, of all hosts and of one, at most; beyond that texts are joined with the places of theirs.
GATHERED, GATHERED_HOST = 500_000, 5_000

SPACE = r"[ \t-\r]+"
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def window_hashes(words: Column) -> Column:
    """A hash of each window of words, none if there are too few."""
    last = F.size(words) - WINDOW
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW)))


def repeated_places(hashes: Column) -> Column:
    """Hash and place of each window, sorted; null if no window comes twice."""
    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("place")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(placed))


def covered_words(places: Column) -> Column:
    """Words that windows at sorted places cover."""
    n = F.size(places)
    gaps = F.zip_with(F.slice(places, 2, n), F.slice(places, 1, F.greatest(n - 1, F.lit(0))), lambda b, a: F.least(F.lit(WINDOW), b - a))
    return F.when(n > 0, F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)).otherwise(0)


def base_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per row: its key, the counts of the base rules, `lines` (hash and place of each line with a word) and `raw`, the text as it came."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.md5(F.col(text)).alias("tie"),
        F.coalesce(F.col(host), F.lit("")).alias("host"),
        F.col(text).alias("raw"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("words", words_of(F.col("text"))).withColumn("hashes", window_hashes(F.col("words")))
    rows = rows.withColumn("sorted", repeated_places(F.col("hashes"))).withColumn("n_windows", F.size("hashes"))
    again = F.filter(
        "sorted",
        lambda x, i: (i > 0) & (F.get("sorted", i - 1)["hash"] == x["hash"]) | (F.get("sorted", i + 1)["hash"] == x["hash"]),
    )
    rows = rows.withColumn("places", F.when(F.col("sorted").isNotNull(), F.sort_array(F.transform(again, lambda x: x["place"]))))
    placed = F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("line"), i.alias("at")))
    placed = F.filter(placed, lambda x: F.length(F.translate(x["line"], " \t\n\x0b\x0c\r", "")) > 0)
    rows = rows.withColumn("placed", placed).withColumn("full_lines", F.transform("placed", lambda x: x["line"]))
    normal = F.transform(
        "placed", lambda x: F.struct(F.substring(F.md5(F.lower(F.array_join(words_of(x["line"]), " "))), 1, 16).alias("line"), x["at"].alias("at"))
    )
    return rows.select(
        "doc_id",
        "tie",
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("full_lines") - F.size(F.array_distinct("full_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("places").isNotNull(), covered_words(F.col("places"))), F.lit(0)).cast("long").alias("n_repeat_words"),
        normal.alias("lines"),
        "raw",
    )


def frequent_lines(ruled: DataFrame) -> DataFrame:
    """host and line of the lines to remove."""
    ordered = F.array_sort(F.array_distinct(F.transform("lines", lambda x: x["line"])))
    apart = ruled.select("host", ordered.alias("ordered")).distinct()
    counted = apart.select("host", F.explode("ordered").alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    sizes = apart.groupBy("host").agg(F.count(F.lit(1)).alias("n_host"))
    common = counted.where(F.col("n") >= LINE_DOCUMENTS).join(sizes, "host")
    return common.where(100 * F.col("n") >= LINE_SHARE * F.col("n_host")).select("host", "line")


def held_by_host(ruled: DataFrame, frequent: DataFrame) -> DataFrame:
    """`ruled` with `held`, the places of frequent lines: looked up in those of the row's host."""
    gathered = frequent.groupBy("host").agg(F.collect_list("line").alias("frequent"))
    found = ruled.join(F.broadcast(gathered), "host", "left").select(*ruled.columns, "frequent")
    common = F.array_intersect(F.transform("lines", lambda x: x["line"]), "frequent")
    found = found.withColumn("common", F.when(F.col("frequent").isNotNull(), common))
    places = F.transform(F.filter("lines", lambda x: F.array_contains("common", x["line"])), lambda x: x["at"])
    return found.withColumn("held", F.when(F.size("common") > 0, places)).drop("lines", "frequent", "common")


def held_by_row(ruled: DataFrame, lined: DataFrame, frequent: DataFrame, key: list[str]) -> DataFrame:
    """The same by joins of lines, and of their places with the texts."""
    lines = lined.select(*key, F.explode("lines").alias("x")).select(*key, "x.at", "x.line").join(frequent, ["host", "line"])
    # a set, as equal rows hold the same lines at the same places
    held = lines.groupBy(*key).agg(F.collect_set("at").alias("held"))
    return ruled.drop("lines").alias("b").join(held.alias("r"), [F.col(f"b.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key], "left").select("b.*", "r.held")


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per row its id, the counts of the base rules, `cleaned` (the text without frequent lines), `words_removed` with them, `base_failed` and `kept`."""
    ruled = base_rules(docs, doc_id, text, host)
    key = ["doc_id", "tie", "host"]
    # the lines alone are staged, for the counts over documents
    lined = stage(ruled.select(*key, "lines"), "quality-lines")
    frequent = stage(frequent_lines(lined), "quality-frequent")
    size = frequent.groupBy("host").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    if size["all"] <= GATHERED and size["most"] <= GATHERED_HOST:
        found = held_by_host(ruled, frequent)
    else:
        found = held_by_row(ruled, lined, frequent, key)
    left = F.array_join(F.filter(F.split("raw", "\n"), lambda x, i: ~F.array_contains("held", i)), "\n")
    found = found.withColumn("cleaned", F.when(F.col("held").isNotNull(), left).otherwise(F.col("raw")))
    gone = F.when(F.col("held").isNotNull(), F.col("n_words") - F.size(words_of(F.col("cleaned")))).otherwise(0)
    found = found.withColumn("words_removed", gone.cast("long")).drop("raw", "held")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    depleted = 100 * (F.col("n_words") - F.col("words_removed")) < LEFT * F.col("n_words")
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~depleted)
