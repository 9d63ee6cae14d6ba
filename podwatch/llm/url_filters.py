"""URL filtering by lists that change over time. DataFrame functions only.

List entries are dated: an entry says that from a moment on a host, a domain or the start of a path is
blocked, allowed, or no longer listed. Per list and pattern they become validity intervals, and a capture is
judged by the entries that were active when it was fetched.

The as-of join is an equi-join on (pattern, slot of time): an interval is put into every slot it touches,
a capture into its own. So a host with a third of all captures is spread over time, and no list history
is compared with captures of other times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_DAYS = 30
_SLOT = SLOT_DAYS * 86_400


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none."""
    return F.rtrim(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit("."))


def _path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def url_patterns(url: Column, depth: int | None = None) -> Column:
    """All patterns that can match the URL: its host, the domains above it, and its host with leading path parts, ``depth`` of them at most."""
    host = url_host(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("*."), F.array_join(F.slice(labels, i, n), ".")))
    parts = F.filter(F.split(_path(url), "/"), lambda p: p != "")
    deepest = F.size(parts) if depth is None else F.least(F.size(parts), F.lit(depth))
    paths = F.when(deepest > 0, F.transform(F.sequence(F.lit(1), deepest), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))))
    found = F.concat(F.array(host), domains, F.coalesce(paths, F.array().cast("array<string>")))
    return F.when(host != "", found).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, action, since, until) from entries (list, pattern, action, since); until is open if NULL.

    Of entries of one list and pattern at one moment the last by action counts. An action that is neither
    block nor allow ends what was listed. Entries without list, pattern or moment are left out.
    """
    clean = entries.where("list is not null and pattern is not null and since is not null")
    clean = clean.groupBy("list", "pattern", "since").agg(F.max("action").alias("action"))
    later = Window.partitionBy("list", "pattern").orderBy("since")
    clean = clean.withColumn("until", F.lead("since").over(later))
    return clean.where("action in ('block', 'allow')").select("list", "pattern", "action", "since", "until")


def _slot(seconds: Column) -> Column:
    return F.floor(seconds / _SLOT)


def url_verdicts(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per distinct capture (page_id, url, fetched_at) with host, verdict, list, pattern and since.

    The longest pattern decides, a host before a domain of its length; then allow before block, then the
    later entry, then the list's name. ``verdict`` is none where no entry is active; a URL without a host and
    a capture without a time match nothing. Timestamps are in the session's zone on both sides.
    """
    captures = captures.select("page_id", "url", "fetched_at").distinct()
    last = captures.agg(F.max(F.unix_timestamp("fetched_at"))).first()[0]
    depth = entries.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0  # no entry names more path parts
    spans = intervals(entries).where(F.unix_timestamp("since") <= F.lit(last))
    end = F.least(F.coalesce(F.unix_timestamp("until"), F.lit(last)), F.lit(last))
    slots = F.sequence(_slot(F.unix_timestamp("since")), _slot(end))
    spans = spans.select("list", "pattern", "action", "since", "until", F.explode(slots).alias("slot"))

    keys = captures.where("fetched_at is not null").select(
        "page_id", "url", "fetched_at", _slot(F.unix_timestamp("fetched_at")).alias("slot"), F.explode(url_patterns(F.col("url"), depth)).alias("pattern")
    )
    active = (F.col("since") <= F.col("fetched_at")) & (F.col("until").isNull() | (F.col("fetched_at") < F.col("until")))
    hits = keys.join(spans, ["pattern", "slot"]).where(active)
    rank = F.struct(
        F.length(F.regexp_replace("pattern", r"^\*\.", "")).alias("size"),
        (~F.col("pattern").startswith("*.")).alias("exact"),
        (F.col("action") == "allow").alias("allow"),
        "since", "list", "pattern", "action",
    )
    best = hits.groupBy("page_id", "url", "fetched_at").agg(F.max(rank).alias("best"))
    best = best.select("best", *(F.col(c).alias(f"of_{c}") for c in ("page_id", "url", "fetched_at")))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in ("page_id", "url", "fetched_at")]
    judged = captures.join(best, same[0] & same[1] & same[2], "left")
    return judged.select(
        "page_id",
        "url",
        url_host(F.col("url")).alias("host"),
        "fetched_at",
        F.coalesce(F.col("best.action"), F.lit("none")).alias("verdict"),
        *(F.col(f"best.{c}").alias(c) for c in ("list", "pattern", "since")),
    )
