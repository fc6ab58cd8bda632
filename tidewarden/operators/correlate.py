"""Correlation groups: events that share an id inside a tumbling window.

One shape for groups of any size: an event carries its group's key and exact counts;
members, services and links are rows (``correlation_members``,
``correlation_services``, ``context_links``). A list of members on every member would
be quadratic and is not formed; ``member_chunks`` writes a group's members as
records of bounded length, ``ordered_member_chunks`` and ``context_id_chunks`` so that the
records of a group, one after the other, are its list in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import window_bounds
from ..functions.positions import with_positions
from ..functions.skew import join_groups
from ..functions.text import has_text, json_object
from ..session import written_once

KEYS = ["window_start", "window_end", "correlation_id"]
METRIC_GROUP = ["window_start", "window_end", "source", "metric"]
CHUNK = 500
#: Pieces of each correlation group that meet its links apart, so a hot group is shared out.
LINK_SLICES = 16


def correlated(events: DataFrame) -> DataFrame:
    """Events whose correlation id holds any visible character."""
    return events.where(F.col("correlation_id").isNotNull() & has_text("correlation_id"))


def with_window(events: DataFrame, bucket: str) -> DataFrame:
    return events.select("*", *window_bounds("ts", bucket, events.schema["ts"].dataType))


def correlation_services(events: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """The services of every group as rows, with the number of events of each."""
    return _services(with_window(correlated(events), bucket)).where(F.col("source").isNotNull())


def _services(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS, "source").agg(F.count(F.lit(1)).alias("events"))


def correlation_groups(events: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """One row per group: size and number of distinct services."""
    return _sizes(with_window(correlated(events), bucket))


def _sizes(rows: DataFrame) -> DataFrame:
    return _services(rows).groupBy(*KEYS).agg(
        F.sum("events").alias("correlated_count"),
        F.count("source").cast("int").alias("unique_services"),
    )


def correlation_members(events: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """The member ids of every group as rows, with the number of copies of each."""
    rows = with_window(correlated(events), bucket).where(F.col("id").isNotNull())
    return rows.groupBy(*KEYS, F.col("id").alias("member_id")).agg(
        F.count(F.lit(1)).alias("copies"), F.min("ts").alias("first_ts")
    )


def member_chunks(events: DataFrame, bucket: str = "1 minute", length: int = CHUNK) -> DataFrame:
    """All members of every group in records of about ``length`` ids, none left out.

    A hash of the id names the chunk, so chunks are made by as many tasks as there are
    chunks; their number follows from the group's own count of ids.
    """
    members = correlation_members(events, bucket)
    sizes = members.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("ids"))
    numbered = join_groups(members, sizes, KEYS, "ids", ["member_id"]).withColumn(
        "chunk", F.pmod(F.xxhash64("member_id"), F.ceil(F.col("ids") / F.lit(length))).cast("int")
    )
    return numbered.groupBy(*KEYS, "chunk").agg(
        F.array_sort(F.collect_list(F.struct("member_id", "copies"))).alias("members")
    )


def ordered_member_chunks(
    events: DataFrame, bucket: str = "1 minute", length: int = CHUNK, order: str = "ts", partitions: int | None = None
) -> DataFrame:
    """The members of every group in the order of ``order`` and id, in records of exactly ``length`` entries.

    ``order`` names a column, such as the time of receipt. Entries are (member_id, copies); equal
    rows are one entry with a count. The records of a group in the order of ``chunk`` are its
    list; only the last may be shorter. Members without an id are left out.
    """
    rows = with_window(correlated(events), bucket).where(F.col("id").isNotNull())
    entries = rows.groupBy(*KEYS, F.col(order).alias("placed_by"), F.col("id").alias("member_id")).agg(
        F.count(F.lit(1)).alias("copies")
    )
    placed = with_positions(entries, KEYS, ["placed_by", "member_id"], partitions)
    return _records(placed, KEYS, length, "members", ["member_id", "copies"])


def _records(placed: DataFrame, keys: list[str], length: int, name: str, content: list[str]) -> DataFrame:
    """Rows with positions as records of ``length`` entries in order."""
    chunk = F.floor(F.col("position") / F.lit(length)).cast("long").alias("chunk")
    listed = F.array_sort(F.collect_list(F.struct("position", *content)))
    entry = (lambda e: e[content[0]]) if len(content) == 1 else (lambda e: F.struct(*[e[c].alias(c) for c in content]))
    return placed.groupBy(*keys, chunk).agg(F.transform(listed, entry).alias(name))


def correlate(events: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """Each correlated event with its group's window, size and number of services."""
    rows = with_window(correlated(events), bucket)
    joined = join_groups(rows, _sizes(rows), KEYS, "correlated_count", ["id", "ts"])
    return joined.select(
        *events.columns, "window_start", "window_end", "correlated_count", "unique_services"
    )


def enriched_record(rows: DataFrame) -> DataFrame:
    """Flat output of :func:`correlate` as the nested wire record."""
    return rows.select(
        F.struct(
            "id", "source", "type", "subtype", "payload", "ts", "correlation_id", "tags"
        ).alias("original"),
        "window_start",
        "window_end",
        F.struct(
            F.col("correlated_count").alias("correlatedCount"),
            F.col("unique_services").alias("uniqueServices"),
        ).alias("enrichment_metadata"),
    )


def context_links(firing: DataFrame, samples: DataFrame) -> DataFrame:
    """Correlation groups that contribute to each firing metric group, as rows.

    With :func:`correlation_members` this is the whole context in factored form:
    metric group to correlation group, correlation group to member. Its product
    (every member once per metric group) is never formed for large groups.
    """
    links = samples.select(*METRIC_GROUP, "correlation_id").distinct()
    return links.join(firing.select(*METRIC_GROUP), METRIC_GROUP, "left_semi")


def context_id_chunks(
    links: DataFrame, events: DataFrame, bucket: str, length: int = CHUNK, partitions: int | None = None
) -> DataFrame:
    """The distinct ids behind every firing metric group, sorted, in records of exactly ``length`` ids.

    The records of a metric group in the order of ``chunk`` are its list. Ids of a
    correlation group meet its metric groups in ``LINK_SLICES`` pieces.
    """
    members = correlation_members(events, bucket).select(
        *KEYS, "member_id", F.pmod(F.xxhash64("member_id"), F.lit(LINK_SLICES)).cast("int").alias("_slice")
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(LINK_SLICES - 1))).alias("_slice")
    ids = links.select("*", every).join(members, [*KEYS, "_slice"]).select(*METRIC_GROUP, "member_id").distinct()
    placed = with_positions(ids, METRIC_GROUP, ["member_id"], partitions)
    return _records(placed, METRIC_GROUP, length, "ids", ["member_id"])


def context_counts(links: DataFrame, events: DataFrame, bucket: str) -> DataFrame:
    """Per firing metric group the exact number of distinct ids behind it and of services.

    Only events of linked correlation groups are read on. Ids found in one correlation
    group of a window are added up as counts; just those found in several are followed one by one.
    """
    window = ["window_start", "window_end"]
    wanted = links.select(*KEYS).distinct()
    linked = with_window(events, bucket).join(wanted, KEYS, "left_semi")
    pairs = written_once(linked.groupBy(*KEYS, "source", "id").agg(F.count(F.lit(1)).alias("_n")), "linked-pairs")
    homes = pairs.where(F.col("id").isNotNull()).groupBy(*window, "id").agg(
        F.count_distinct("correlation_id").alias("homes"), F.min("correlation_id").alias("home")
    )
    own = homes.where("homes = 1").groupBy(*window, F.col("home").alias("correlation_id")).agg(
        F.count(F.lit(1)).alias("own")
    )
    several = pairs.join(homes.where("homes > 1").select(*window, "id"), [*window, "id"], "left_semi")
    counted = links.join(own, KEYS, "left").groupBy(*METRIC_GROUP).agg(
        F.sum(F.coalesce("own", F.lit(0))).alias("own")
    )
    shared = (
        links.join(several.select(*KEYS, "id").distinct(), KEYS)
        .select(*METRIC_GROUP, "id").distinct()
        .groupBy(*METRIC_GROUP).agg(F.count(F.lit(1)).alias("shared"))
    )
    services = context_services(links, pairs).groupBy(*METRIC_GROUP).agg(F.count("service").alias("services"))
    return (
        counted.join(shared, METRIC_GROUP, "left").join(services, METRIC_GROUP, "left")
        .select(
            *METRIC_GROUP,
            (F.col("own") + F.coalesce("shared", F.lit(0))).alias("ids"),
            F.coalesce("services", F.lit(0)).alias("services"),
        )
    )


def context_services(links: DataFrame, services: DataFrame) -> DataFrame:
    """The services behind each firing metric group as rows; ``services`` has the groups' sources."""
    named = services.where(F.col("source").isNotNull()).select(*KEYS, F.col("source").alias("service"))
    return links.join(named.distinct(), KEYS).select(*METRIC_GROUP, "service").distinct()


def attach_context(hits: DataFrame, links: DataFrame, events: DataFrame, bucket: str) -> DataFrame:
    """Extend the details of enriched hits with the group-wide counts of ids and services.

    ``links`` are the rows of :func:`context_links` for the hits' metric groups.
    The ids and services themselves are the rows of :func:`context_links`,
    :func:`correlation_members` and :func:`context_services`.
    """
    counts = context_counts(links, events, bucket)
    sizes = hits.groupBy("window_start", "window_end", "service", "metric").agg(F.count(F.lit(1)).alias("_hits"))
    keys = ["window_start", "window_end", "service", "metric"]
    wide = sizes.join(
        counts.withColumnsRenamed({"source": "service", "services": "unique_services"}), keys, "left"
    )
    details = json_object(
        value=F.col("value"), mean=F.col("mean"), stddev=F.col("stddev"),
        zScore=F.col("score"), windowSize=F.col("events"),
        correlatedCount=F.coalesce("ids", F.lit(0)),
        uniqueServices=F.coalesce("unique_services", F.lit(0)),
    )
    joined = join_groups(hits, wide, keys, "_hits", ["event_id", "value"])
    return joined.withColumn("details", details)
