"""Not-modified revisit resolution for web captures.

A revisit record says that a page had not changed; its payload is that of an earlier
capture.  Each revisit is joined, as of its time, to the latest earlier full response of
the same canonical URL.  Their validators are compared, and the stored headers are updated
with those that a not-modified answer may change.

The as-of join never needs a URL in one task.  Records of one URL and time become one row, so that however many
there are count as one; time is cut into at most ``buckets`` of about equally many records, by approximate quantiles
of the times, so that an outlying time does not crowd the others into one bucket.  A window inside a
(URL, bucket) finds the latest earlier response there; before the first of a bucket, the
last response of the URL's earlier buckets holds, which a window over at most ``buckets``
rows per URL carries forward.  The revisits then join their URL and time.

Defined results: a revisit without an earlier response is an orphan; "earlier" is strict, and
of responses of the same time the largest record id counts; records without a URL
or time resolve to nothing; headers that repeat are joined by commas; an empty table gives
no rows; repeated revisit rows are resolved each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024
# Bounds that are compared one by one: first the last of every such group, then those of one group.
STEP = 32

# Query parameters that do not name a page.
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid|sessionid)(=|$)"

# Stored headers that a not-modified answer must not replace.
PROTECTED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
)

_URL = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, www., default port, fragment, tracking and a last slash.

    Parameters are sorted.  What is no absolute URL stays as it is, trimmed.
    """
    plain = F.trim(url)
    host = F.regexp_replace(F.lower(F.regexp_extract(plain, _URL, 1)), r"^(?:[^@]*@)?(?:www\.)?|:(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(plain, _URL, 2), "/+$", "")
    params = F.filter(F.split(F.regexp_extract(plain, _URL, 3), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(params), "&"))).otherwise("")
    return F.when(plain.rlike(_URL), F.concat(host, path, query)).otherwise(plain)


def parsed_headers(block: Column) -> Column:
    """Map of lower-cased names to values from a block of ``Name: value`` lines."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), "\r?\n"), lambda s: F.instr(s, ":") > 1)
    pairs = F.transform(
        lines,
        lambda s: F.struct(
            F.lower(F.trim(F.substring_index(s, ":", 1))).alias("name"),
            F.trim(F.substring(s, F.instr(s, ":") + 1, F.length(s))).alias("value"),
        ),
    )
    names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))
    values = F.transform(
        names, lambda n: F.array_join(F.transform(F.filter(pairs, lambda p: p["name"] == n), lambda p: p["value"]), ", ")
    )
    return F.map_from_arrays(names, values)


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored headers, overlaid with those of the update that may change."""
    allowed = F.map_filter(update, lambda k, v: ~k.isin(*PROTECTED))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k)), allowed)


def _opaque(etag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(etag, "^W/", "")


def time_bounds(times: DataFrame, buckets: int) -> list[int]:
    """At most ``buckets`` - 1 times that cut the column ``_ts`` into about equal parts."""
    shares = [k / buckets for k in range(1, buckets)]
    found = times.agg(F.percentile_approx("_ts", shares, F.lit(10 * max(buckets, 1000)))).first()[0] if shares else None
    return sorted(set(found or []))


def bucket_of(ts: Column, bounds: list[int]) -> Column:
    """How many of the bounds are not later than ``ts``."""

    def array(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")  # folded into one literal

    if not bounds:
        return F.lit(0)
    groups = bounds[STEP - 1 :: STEP]
    whole = F.size(F.filter(array(groups), lambda b: b <= ts)) if groups else F.lit(0)
    rest = F.slice(array(bounds), whole * STEP + 1, F.lit(STEP))
    return whole * STEP + F.size(F.filter(rest, lambda b: b <= ts))


def resolve(records: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row per revisit: record_id, canonical_url, resolved_id, status, headers.

    ``records`` has record_id long, url, ts long, kind ('response' or 'revisit'), headers (a block
    of lines) and payload_digest.  status: resolved, mismatch (a validator differs),
    unverified (no validator in common) or orphan.
    """
    rows = records.select(
        "record_id", canonical_url(F.col("url")).alias("_url"), F.col("ts").cast("long").alias("_ts"),
        (F.col("kind") == "response").alias("_full"), parsed_headers(F.col("headers")).alias("_headers"),
        F.col("payload_digest").alias("_digest"),
    ).where(F.col("kind").isin("response", "revisit"))
    known = rows.where(F.col("_url").isNotNull() & F.col("_ts").isNotNull())
    lost = rows.where((F.col("_url").isNull() | F.col("_ts").isNull()) & ~F.col("_full"))
    full = F.when(F.col("_full"), F.struct("record_id", "_headers", "_digest"))
    # one row per URL and time, with the response of that time, if any
    times = known.groupBy("_url", "_ts").agg(
        F.max_by(full, F.when(F.col("_full"), F.struct("record_id"))).alias("_last"), F.bool_or(~F.col("_full")).alias("_asked")
    )
    cut = times.withColumn("_bucket", bucket_of(F.col("_ts"), time_bounds(known, buckets)))
    # URLs' buckets, with the last response of earlier ones
    ends = cut.groupBy("_url", "_bucket").agg(F.max_by("_last", F.when(F.col("_last").isNotNull(), F.col("_ts"))).alias("_last"))
    before = Window.partitionBy("_url").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_url", "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_before"))
    earlier = Window.partitionBy("_url", "_bucket").orderBy("_ts").rowsBetween(Window.unboundedPreceding, -1)
    inside = cut.withColumn("_found", F.last("_last", ignorenulls=True).over(earlier)).where("_asked")
    answers = inside.join(carried, ["_url", "_bucket"], "left").select("_url", "_ts", F.coalesce("_found", "_before").alias("_full"))
    asked = known.where("NOT _full").select("record_id", "_url", "_ts", "_headers", "_digest")
    placed = asked.join(answers, ["_url", "_ts"], "left").select("record_id", "_url", "_headers", "_digest", "_full")
    nothing = F.lit(None).cast(placed.schema["_full"].dataType)
    placed = placed.unionByName(lost.select("record_id", "_url", "_headers", "_digest", nothing.alias("_full")))

    etag, old_etag = _opaque(F.col("_headers")["etag"]), _opaque(F.col("_full._headers")["etag"])
    date, old_date = F.col("_headers")["last-modified"], F.col("_full._headers")["last-modified"]
    same = F.coalesce(etag == old_etag, date == old_date, F.col("_digest") == F.col("_full._digest"))
    status = (
        F.when(F.col("_full").isNull(), "orphan").when(same.isNull(), "unverified").when(same, "resolved").otherwise("mismatch")
    )
    return placed.select(
        "record_id",
        F.col("_url").alias("canonical_url"),
        F.col("_full.record_id").alias("resolved_id"),
        status.alias("status"),
        F.when(F.col("_full").isNotNull() & F.coalesce(same, F.lit(False)), merged_headers(F.col("_full._headers"), F.col("_headers")))
        .otherwise(F.col("_headers")).alias("headers"),
    )
