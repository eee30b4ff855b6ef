"""Rows that change: one version of a row for each time in which its values held."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.intervals import interval_join
from starloom.operators.ranges import in_ranges, numbered
from starloom.staging import settle

FROM, TO, HASH = "ValidFrom", "ValidTo", "RowHash"


def row_hash(columns: Sequence[str]) -> Column:
    """128 bits over names and values; null is not the empty text."""
    return F.md5(F.to_json(F.struct(*sorted(columns))).cast("binary"))


def merge_versions(
    held: DataFrame | None,
    snapshot: DataFrame,
    keys: Sequence[str],
    day: date,
    number: str,
    since: date | None = None,
    close_missing: bool = False,
) -> DataFrame:
    """The versions after ``snapshot``, the rows as they are on ``day``: a row for each version, with
    ``number`` (its key for facts), the snapshot's columns, ValidFrom, ValidTo and RowHash, written.

    A row whose values are as in its current version changes nothing, so a snapshot can be loaded
    twice. Other values close the current version the day before and open a new one; if the current
    version began on the same day, they replace it under its number. With ``close_missing`` a key that the
    snapshot lacks is closed; when it comes back it has a new version. Versions of a first load
    begin with ``since``, null: at any time before. New versions are numbered after the highest
    held, in the order of the keys, and a number is never given twice. A null key is a key; a key that occurs twice in the snapshot
    raises; so does a snapshot older than the last change.

    One shuffle by key of the snapshot with the current versions; closed versions are not touched.
    """
    columns = snapshot.columns
    taken = sorted({FROM, TO, HASH, number}.intersection(columns))
    if taken:
        raise ValueError(f"the snapshot has columns that versions get: {', '.join(taken)}")
    values = [c for c in columns if c not in keys]
    several = F.raise_error(F.lit("a key occurs twice in the snapshot"))
    new = snapshot.withColumn(HASH, row_hash(values))
    schema = [*columns, FROM, TO, HASH]
    if held is None:
        once = F.when(F.count(F.lit(1)) == 1, F.first(F.struct(*columns, HASH))).otherwise(several)
        first = new.groupBy(*keys).agg(once.alias("_new")).select("_new.*")
        first = first.withColumns({FROM: F.lit(since).cast("date"), TO: F.lit(None).cast("date")})
        placed = in_ranges(first.select(*schema), [*keys], "versions")
        return settle(numbered(placed, number).select(number, *schema), "versions")
    last = held.agg(F.max(number), F.max(FROM), F.max(TO)).first()
    if any(x is not None and x > limit for x, limit in ((last[1], day), (last[2], day))):
        raise ValueError(f"versions have changed after {day}: load snapshots in the order of their days")
    today, eve = F.lit(day).cast("date"), F.date_sub(F.lit(day).cast("date"), 1)
    is_open, of_eve = F.col(TO).isNull(), F.coalesce(F.col(TO) == eve, F.lit(False))
    whole = F.struct(F.col(number).cast("bigint").alias(number), *schema)
    versions = held.where(is_open | of_eve).select(
        *keys, F.when(is_open, whole).alias("_old"), F.when(of_eve, whole).alias("_eve")
    )
    fresh = new.select(*keys, F.struct(*columns, HASH).alias("_new"))
    both = versions.unionByName(fresh, allowMissingColumns=True).groupBy(*keys)
    both = both.agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("_old", "_eve")],
        F.when(F.count("_new") <= 1, F.first("_new", ignorenulls=True)).otherwise(several).alias("_new"),
    )
    old, given, ended = F.col("_old"), F.col("_new"), F.col("_eve")

    def version(of: Column, no: Column, begin: Column, end: Column) -> Column:
        names = [*columns, HASH]
        parts = {number: no.cast("bigint"), FROM: begin, TO: end, **{c: of[c] for c in names}}
        return F.struct(*[parts[c].alias(c) for c in (number, *schema)])

    never = F.lit(None).cast("date")
    kept = version(old, old[number], old[FROM], never)
    closed = version(old, old[number], old[FROM], eve)
    opened = version(given, F.lit(None), today, never)
    # a version of today is corrected under its number; it was never in force otherwise
    corrected = version(given, old[number], old[FROM], never)
    of_today = F.coalesce(old[FROM] == today, F.lit(False))
    restored = F.coalesce(ended[HASH] == given[HASH], F.lit(False)) & (old.isNull() | of_today)
    reopened = version(ended, ended[number], ended[FROM], never)
    still = version(ended, ended[number], ended[FROM], ended[TO])
    before = F.when(ended.isNotNull(), F.array(still)).otherwise(F.filter(F.array(opened), lambda v: F.lit(False)))
    gone = F.filter(F.array(closed), lambda v: ~of_today) if close_missing else F.array(kept)
    gone = F.when(old.isNotNull(), gone).otherwise(F.filter(F.array(opened), lambda v: F.lit(False)))
    rows = (
        F.when(given.isNull(), F.concat(gone, before))
        .when(restored, F.array(reopened))
        .when(old.isNull(), F.concat(F.array(opened), before))
        .when(old[HASH] == given[HASH], F.concat(F.array(kept), before))
        .when(of_today, F.concat(F.array(corrected), before))
        .otherwise(F.array(closed, opened))
    )
    merged = settle(both.select(F.explode(rows).alias("_v")).select("_v.*"), "merged_versions")
    placed = in_ranges(merged.where(F.col(number).isNull()).drop(number), [*keys], "new_versions")
    opened_rows = numbered(placed, number, last[0] or 0).select(number, *schema)
    out = merged.where(F.col(number).isNotNull()).unionByName(opened_rows)
    past = held.where(~is_open & ~of_eve).select(F.col(number).cast("bigint").alias(number), *schema)
    return settle(out.unionByName(past), "versions")


def version_at(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    take: Sequence[str],
    how: str = "left",
    hot: dict | None = None,
) -> DataFrame:
    """``facts`` with the ``take`` columns of the version of ``keys`` that held on the day ``at``."""
    side = versions.select(*keys, *take, FROM, TO)
    joined = interval_join(facts, side, keys, (at, at), (FROM, TO), how, hot)
    return joined.select(*facts.columns, *take)
