"""Keyed upsert of token metadata as one set-based join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podwatch import fixed_values as fv
from podwatch.functions.text import is_blank
from podwatch.functions.timing import kind_of
from podwatch.schemas import TOKEN_METADATA_COLUMNS

# Columns a match overwrites, next to inserted_at.
BATCH_UPDATES = ("symbol", "name", "decimals", "blockchain")
API_UPDATES = ("symbol", "name", "decimals")


class BadLoadError(ValueError):
    """A batch whose key is null or repeated."""


def check_keys(source: DataFrame, key: str = "address") -> DataFrame:
    """The batch itself, after one job that proves its key is never null and never repeated."""
    repeated = F.col("n") > 1
    bad = source.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col(key).isNull() | repeated)
    first = bad.limit(1).collect()
    if first:
        raise BadLoadError(f"{key} {first[0][key]!r} occurs {first[0]['n']} times in the batch")
    return source


def upsert(
    target: DataFrame,
    source: DataFrame,
    now: Column,
    update_columns: Sequence[str] = BATCH_UPDATES,
    keep_known: bool = False,
    source_is_small: bool = False,
) -> DataFrame:
    """Target after the batch, both with one row per address.

    A match takes ``update_columns`` and ``inserted_at = now`` from the batch; a new address is added,
    on the default chain where the batch names none. ``keep_known`` leaves a symbol or name alone
    where the batch has only an empty one. A batch whose size was found to be small
    (``source_is_small``) is broadcast, and the target is then read without a shuffle.
    """
    if "blockchain" not in (c.lower() for c in source.columns):
        source = source.withColumn("blockchain", F.lit(fv.DEFAULT_BLOCKCHAIN))
    target = target.select(*TOKEN_METADATA_COLUMNS)
    kind = {c: kind_of(target, c) for c in TOKEN_METADATA_COLUMNS}
    t, s = target.alias("t"), source.alias("s")
    in_target, in_source = F.col("t.address").isNotNull(), F.col("s.address").isNotNull()

    def merged(column: str) -> Column:
        old, new = F.col(f"t.{column}"), F.col(f"s.{column}").cast(kind[column])
        if column not in update_columns:
            return F.when(in_target, old).otherwise(new)
        if keep_known and column in ("symbol", "name"):
            new = F.when(is_blank(new) & in_target, old).otherwise(new)
        return F.when(in_source, new).otherwise(old)

    columns = {
        "address": F.coalesce("t.address", "s.address"),
        **{c: merged(c) for c in ("symbol", "name", "decimals", "blockchain")},
        "inserted_at": F.when(in_source, now.cast(kind["inserted_at"])).otherwise(F.col("t.inserted_at")),
    }
    after = [columns[c].alias(c) for c in TOKEN_METADATA_COLUMNS]
    same = F.col("t.address") == F.col("s.address")
    if not source_is_small:
        return t.join(s, same, "full_outer").select(*after)
    known = target.select("address").join(F.broadcast(source.select("address")), "address", "left_semi")
    new = source.join(F.broadcast(known), "address", "left_anti")
    nobody = target.limit(0).alias("t")
    return (
        t.join(F.broadcast(s), same, "left")
        .select(*after)
        .unionByName(new.alias("s").join(nobody, same, "left").select(*after))
    )
