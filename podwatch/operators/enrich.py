"""Token metadata for candidates: lookup, what is missing, responses, fallbacks, deny list."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podwatch import fixed_values as fv
from podwatch.functions.payload import RESPONSE_SCHEMA, is_true
from podwatch.functions.text import is_blank, leading, or_empty
from podwatch.functions.timing import instant_like

LOOKUP_COLUMNS = ("address", "symbol", "name", "decimals")


def lookup_metadata(metadata: DataFrame, tokens: DataFrame) -> DataFrame:
    """Metadata of the tokens asked for. ``tokens`` has a ``token`` column; repeats do not matter.

    Given a broadcast ``tokens``, the metadata is scanned where it lies and not shuffled.
    """
    keys = tokens.select(F.col("token").alias("address"))
    return metadata.select(*LOOKUP_COLUMNS).join(keys, "address", "left_semi")


def missing_tokens(tokens: DataFrame, metadata: DataFrame) -> DataFrame:
    """Distinct tokens with no metadata row."""
    keys = tokens.select(F.col("token").alias("address")).where(F.col("address").isNotNull()).distinct()
    return keys.join(metadata.select("address"), "address", "left_anti")


def incomplete_tokens(found: DataFrame) -> DataFrame:
    """Addresses whose symbol or name is null or empty."""
    return found.where(is_blank(F.col("symbol")) | is_blank(F.col("name"))).select("address").distinct()


def tokens_to_fetch(tokens: DataFrame, metadata: DataFrame) -> DataFrame:
    """Missing and incomplete tokens, each once.

    One left join over the distinct tokens answers both questions: a token without a row has no
    symbol either. Metadata has one row per address, so none is repeated.
    """
    keys = tokens.select(F.col("token").alias("address")).where(F.col("address").isNotNull()).distinct()
    known = metadata.select("address", "symbol", "name")
    return keys.join(known, "address", "left").where(is_blank(F.col("symbol")) | is_blank(F.col("name"))).select("address")


def _answers(responses: DataFrame, as_of: datetime | str | None) -> DataFrame:
    """(address, answer) of each response: when it was fetched and its data; NULL unless it has status 200, a true ``success`` and a ``data`` member.

    Responses without a column ``fetched_at``, or without a time, count as older than all others. With ``as_of``, later ones are not seen.
    """
    timed = "fetched_at" in (c.lower() for c in responses.columns)
    if timed and as_of is not None:
        responses = responses.where(F.col("fetched_at").isNull() | (F.col("fetched_at") <= instant_like(as_of, responses, "fetched_at")))
    at = F.col("fetched_at") if timed else F.lit(None).cast("timestamp")
    parsed = responses.select("address", "status_code", at.alias("at"), F.from_json("body", RESPONSE_SCHEMA).alias("r"))
    accepted = (F.col("status_code") == 200) & is_true(F.col("r.success")) & F.col("r.data").isNotNull()
    return parsed.select("address", F.when(accepted, F.struct("at", F.col("r.data").alias("data"))).alias("answer"))


def accepted_responses(responses: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """The newest valid response of each address, as of a run time if one is given.

    Where several were fetched at once, or without a time, the greatest (symbol, name, decimals) is taken, so a rerun
    gives the same row.
    """
    newest = _answers(responses, as_of).where(F.col("answer").isNotNull()).groupBy("address").agg(F.max("answer").alias("a"))
    return newest.select("address", "a.data.symbol", "a.data.name", "a.data.decimals")


def resolve_responses(addresses: DataFrame, responses: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """One row per distinct address asked for; a failed one has empty symbol and name, NULL decimals.

    Only responses of wanted addresses are parsed: no filter on what they say, as Spark would make it, and parse all, before
    the join. They and the addresses meet in one grouping, where a NULL answer loses to any other.
    """
    keys = addresses.select("address").where(F.col("address").isNotNull())
    answers = _answers(responses.join(keys, "address", "left_semi"), as_of)
    both = answers.unionByName(keys.withColumn("answer", F.lit(None)))
    found = both.groupBy("address").agg(F.max("answer").alias("a"))
    return found.select(
        "address",
        or_empty(F.col("a.data.symbol")).alias("symbol"),
        or_empty(F.col("a.data.name")).alias("name"),
        F.col("a.data.decimals").alias("decimals"),
    )


def lookup_is_empty(candidates: DataFrame, metadata: DataFrame) -> Column:
    """Whether no candidate has metadata at all, as a scalar subquery."""
    return lookup_metadata(metadata, candidates).select((F.count(F.lit(1)) == 0).alias("none_found")).scalar()


def attach_metadata(candidates: DataFrame, metadata: DataFrame, none_found: Column | bool | None = None) -> DataFrame:
    """Candidates with symbol and name.

    A null or empty symbol or name becomes the start of the address; if the lookup found nothing for
    any candidate, the whole address. ``none_found`` gives that fact where the caller knows it.
    Metadata has one row per address, so the join keeps one row per candidate.
    """
    if none_found is None:
        none_found = lookup_is_empty(candidates, metadata)
    elif isinstance(none_found, bool):
        none_found = F.lit(none_found)

    def filled(column: str, n: int) -> Column:
        start = F.when(none_found, F.col("token")).otherwise(leading(F.col("token"), n))
        return F.when(is_blank(F.col(column)), start).otherwise(F.col(column))

    known = metadata.select(F.col("address").alias("token"), "symbol", "name")
    return (
        candidates.join(known, "token", "left")
        .withColumns(
            {
                "symbol": filled("symbol", fv.SYMBOL_FALLBACK_CHARS),
                "name": filled("name", fv.NAME_FALLBACK_CHARS),
            }
        )
    )


def drop_denied(candidates: DataFrame, symbols: tuple[str, ...] = fv.DENIED_SYMBOLS) -> DataFrame:
    """Without the major tokens, by symbol in any case; a null symbol stays."""
    denied = F.upper(F.col("symbol")).isin(*(s.upper() for s in symbols))
    return candidates.where(~F.coalesce(denied, F.lit(False)))
