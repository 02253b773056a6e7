"""Not-modified revisits of a web archive resolved to the responses they stand for.

A revisit says that a page had not changed since an earlier capture. It is joined as of its time to the
latest earlier full response (status 200) of the same canonical URL, and resolved if a validator agrees: the
entity tag where both have one (weak comparison), else the time of last modification, else the digest of the
payload. A resolved revisit has the response's headers, with those that a not-modified answer may update put
in their place.

The join sorts records by URL and time over range partitions, so that a URL with any number of captures is
spread over tasks. Within a partition the latest response is carried forward; what comes before a partition
is added from one row per URL and partition.

Outcomes: `resolved`; `no_response` (no earlier full response, or no URL or time); `no_validator` (the two
share none); `differs` (they share one that disagrees). At equal times the smaller `record_id` is earlier.
Records that repeat an id are records of their own; records of other kinds take no part. A null header map is
empty. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldsync.sources.staging import stage

#: Headers, in lower case, that a not-modified answer may update. Fixed values.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that don't tell pages apart.
TRACKING = "utm_[a-z]+|fbclid|gclid"

_COLUMNS = ("record_id", "kind", "url", "at", "status", "headers", "digest")


def canonical(url: Column) -> Column:
    """A URL without scheme, www, default port, fragment, tracking parameters and final slash; host in lower case, parameters sorted."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(plain, "^[^/?]*", 0)), r"^www\d*\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(plain, r"^[^/?]*([^?]*)", 1), "/+$", "")
    given = F.split(F.regexp_extract(plain, r"\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(given, lambda x: (x != "") & ~x.rlike(f"^(?i:{TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def lowered(headers: Column) -> Column:
    """Header names in lower case; of repeated ones the last."""
    given = F.coalesce(headers, F.create_map().cast("map<string,string>"))
    entries = F.transform(F.map_entries(given), lambda x: F.struct(F.lower(x["key"]).alias("key"), x["value"].alias("value")))
    names = F.array_distinct(F.transform(entries, lambda x: x["key"]))
    return F.map_from_entries(F.transform(names, lambda n: F.element_at(F.filter(entries, lambda x: x["key"] == n), -1)))


def tag(headers: Column) -> Column:
    return F.regexp_replace(F.trim(headers["etag"]), "^W/", "")


def as_of(records: DataFrame) -> DataFrame:
    """Each revisit with the latest earlier full response of its URL, in `response`."""
    rows = records.select(
        "record_id", "kind", canonical(F.col("url")).alias("url"), "at", "status", lowered(F.col("headers")).alias("headers"), "digest"
    ).where(F.col("kind").isin("response", "revisit"))
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    rows = rows.where((F.col("kind") == "revisit") | full).withColumn("response", F.when(full, F.struct("record_id", "at", "headers", "digest")))
    known = F.col("url").isNotNull() & F.col("at").isNotNull()
    order = ["url", "at", "record_id"]
    placed = rows.where(known).repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    placed = stage(placed, "revisits-ranges")
    within = Window.partitionBy("range", "url").orderBy("at", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    near = placed.withColumn("response", F.last("response", ignorenulls=True).over(within)).where("kind = 'revisit'")
    ends = placed.groupBy("range", "url").agg(F.max_by("response", F.when(F.col("response").isNotNull(), F.struct("at", "record_id"))).alias("response"))
    before = Window.partitionBy("url").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("range", "url", F.last("response", ignorenulls=True).over(before).alias("carried")).where("carried IS NOT NULL")
    joined = near.join(carried, ["range", "url"], "left")
    joined = joined.withColumn("response", F.coalesce("response", "carried")).select("record_id", "url", "headers", "digest", "response")
    unknown = rows.where(~known & (F.col("kind") == "revisit")).select("record_id", "url", "headers", "digest", F.lit(None).cast(joined.schema["response"].dataType).alias("response"))
    return joined.union(unknown)


def resolved(records: DataFrame) -> DataFrame:
    """Per revisit: record_id, url, outcome, target_id, payload digest and headers.

    `records`: record_id long, kind, url, at (any ordered type), status int, headers map of texts, digest.
    """
    pairs = as_of(records.select(*_COLUMNS))
    theirs = F.col("response.headers")
    tags = tag(F.col("headers")) == tag(theirs)
    times = F.col("headers")["last-modified"] == theirs["last-modified"]
    digests = F.col("digest") == F.col("response.digest")
    agrees = F.coalesce(tags, times, digests)
    outcome = (
        F.when(F.col("response").isNull(), "no_response")
        .when(agrees.isNull(), "no_validator")
        .when(agrees, "resolved")
        .otherwise("differs")
    )
    updates = F.map_filter("headers", lambda name, _: name.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(theirs, lambda name, _: ~F.coalesce(F.map_contains_key(updates, name), F.lit(False))), updates)
    found = pairs.withColumn("outcome", outcome)
    good = F.col("outcome") == "resolved"
    return found.select(
        "record_id",
        "url",
        "outcome",
        F.when(good, F.col("response.record_id")).alias("target_id"),
        F.when(good, F.col("response.digest")).alias("digest"),
        F.when(good, merged).alias("headers"),
    )


def header_text(headers: Column) -> Column:
    """Headers one per line, by name."""
    lines = F.transform(F.map_entries(headers), lambda x: F.concat(x["key"], F.lit(": "), x["value"]))
    return F.array_join(F.array_sort(lines), "\n")
