"""URL filters: every capture is judged by the list entries that were active when it was fetched.

List entries are dated: a value is added to a list on a day and removed on another. They become
validity intervals, from the day of an addition up to that of the next removal, and an as-of join
finds for each capture the last interval that had begun by its day and whether it still ran.

An entry of kind ``domain`` covers a host and all below it, ``host`` one host, and ``prefix`` a host
with a path up to the end of one of its segments. What is settled is the distinct pairs of entry and
day that captures ask for, of which an entry has no more than there are days; so neither a host with a
third of all captures nor an entry that changes daily makes one task's work. Captures take the verdicts
by equality.

Only DataFrame functions are used. A capture without a host, as of a NULL or broken URL, or without a
day meets no entry and is kept. Entries with a NULL are left out; an addition and a removal of one
value on one day are a removal. Repeated captures and NULL ids stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import stored

ALLOW = "allow"
ADD, REMOVE = "add", "remove"
KINDS = ("domain", "host", "prefix")
# The day after all days.
OPEN = "9999-12-31"

_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """The lower-case host without a closing dot; NULL if there is none."""
    host = F.rtrim(F.regexp_extract(F.lower(url), _HOST, 1), F.lit("."))
    return F.when(host != "", host)


def segments_of(url: Column) -> Column:
    """The segments of the path that are not empty, in their own case."""
    return F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda s: s != "")


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, value, valid_from, valid_to) of (list, kind, value, action, day).

    The end is exclusive, and open ends are ``OPEN``. An addition to what is listed, or a removal of
    what is not, changes nothing.
    """
    key = ["list", "kind", "value"]
    by_day = (
        entries.filter(F.col("action").isin(ADD, REMOVE) & F.col("kind").isin(*KINDS))
        .dropna(subset=[*key, "day"])
        .groupBy(*key, F.col("day").cast("date").alias("day"))
        .agg(F.min(F.col("action") == ADD).alias("listed"))
    )
    days = Window.partitionBy(*key).orderBy("day")
    before = F.coalesce(F.lag("listed").over(days), F.lit(False))
    changes = by_day.withColumn("_before", before).filter("listed <> _before")
    ends = changes.withColumn("valid_to", F.coalesce(F.lead("day").over(days), F.lit(OPEN).cast("date")))
    return ends.filter("listed").select(*key, F.col("day").alias("valid_from"), "valid_to")


def _keys(host: str, segments: str, labels: int, deepest: int) -> Column:
    """The (kind, value) pairs of entries that would cover a capture.

    ``labels`` and ``deepest`` are the most labels of a listed domain and segments of a listed prefix.
    """
    return F.expr(
        f"""concat(
            transform(
                filter(sequence(0, least(size(split({host}, '\\\\.')), {labels})), i -> i > 0),
                i -> named_struct(
                    'kind', 'domain',
                    'value', array_join(slice(split({host}, '\\\\.'), -i, i), '.'))),
            array(named_struct('kind', 'host', 'value', {host})),
            transform(sequence(0, least(size({segments}), {deepest})), i -> named_struct(
                'kind', 'prefix',
                'value', array_join(concat(array({host}), slice({segments}, 1, i)), '/'))))"""
    )


def active(wanted: DataFrame, valid: DataFrame) -> DataFrame:
    """(kind, value, day, list) of the distinct ``wanted`` (kind, value, day) that a list covers.

    The as-of join: wanted days and beginnings of intervals of an entry in one order, each day taking
    the last beginning up to it.
    """
    listed = valid.select("kind", "value", "list").distinct()
    asked = wanted.join(listed, ["kind", "value"]).select(
        "kind",
        "value",
        "list",
        "day",
        F.lit(True).alias("_asked"),
        F.lit(None).cast("date").alias("_end"),
    )
    begun = valid.select(
        "kind",
        "value",
        "list",
        F.col("valid_from").alias("day"),
        F.lit(False).alias("_asked"),
        F.col("valid_to").alias("_end"),
    )
    order = Window.partitionBy("kind", "value", "list").orderBy("day", "_asked")
    ends = F.last("_end", ignorenulls=True).over(order)
    return (
        asked.unionByName(begun)
        .withColumn("_until", ends)
        .filter(F.col("_asked") & (F.col("_until") > F.col("day")))
        .select("kind", "value", "day", "list")
    )


def judged(
    captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at"
) -> DataFrame:
    """``captures`` with ``lists``, the lists with an active entry, ``n_entries`` and ``kept``.

    A capture is dropped if a list covers it that is not the one of exceptions, unless that one
    covers it too. Input columns of the new names are replaced.
    """
    kept = [c for c in captures.columns if c not in {"lists", "n_entries", "kept"}]
    given = captures.select(
        *kept,
        host_of(F.col(url)).alias("_host"),
        segments_of(F.col(url)).alias("_segments"),
        F.to_date(F.col(fetched)).alias("_day"),
    )
    valid = stored(intervals(entries), "intervals", narrow=True)
    # No host or path is followed deeper than the deepest entry.
    depth = F.when(F.col("kind") == "domain", F.size(F.split("value", r"\."))).otherwise(
        F.size(F.split("value", "/")) - 1
    )
    most = dict(valid.groupBy("kind").agg(F.max(depth)).toLocalIterator())
    place = ["_host", "_segments", "_day"]
    asked = (
        given.select(*place)
        .dropna(subset=["_host", "_day"])
        .distinct()
        .select(*place, F.explode(_keys("_host", "_segments", most.get("domain", 0), most.get("prefix", 0))).alias("_key"))
        .select(*place, "_key.kind", "_key.value")
    )
    wanted = asked.select("kind", "value", F.col("_day").alias("day")).distinct()
    verdicts = stored(active(wanted, valid), "verdicts", narrow=True).withColumnRenamed("day", "_day")
    covered = stored(
        asked.join(verdicts, ["kind", "value", "_day"])
        .groupBy(*place)
        .agg(
            F.array_sort(F.collect_set("list")).alias("lists"),
            F.count(F.lit(1)).alias("n_entries"),
        ),
        "covered",
    )
    lists = F.coalesce("lists", F.array().cast("array<string>"))
    allowed = F.array_contains(lists, F.lit(ALLOW))
    return given.join(covered, place, "left").select(
        *kept,
        lists.alias("lists"),
        F.coalesce("n_entries", F.lit(0)).alias("n_entries"),
        (allowed | (F.size(lists) == 0)).alias("kept"),
    )
