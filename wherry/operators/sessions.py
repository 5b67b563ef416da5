"""Sessions and touchpoints from page views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wherry.functions.text import hash_key
from wherry.sources.tables import micros

#: A gap of more than 30 whole minutes starts a session: 31 minutes elapsed.
GAP_MICROS = 31 * 60 * 1_000_000


def visitor_key(anonymous: Column, user: Column, page: Column) -> Column:
    return F.coalesce(anonymous.cast("string"), user.cast("string"), page.cast("string"))


def _keys(visitor: str | list[str]) -> list[str]:
    return [visitor] if isinstance(visitor, str) else list(visitor)


def sessionize(pages: DataFrame, visitor: str | list[str] = "visitor", time: str = "ts", page: str = "page_id", gap_micros: int = GAP_MICROS) -> DataFrame:
    """pages with session_number and session_id; rows without a time are dropped, equal times are ordered by page.

    One exchange on the visitor; all three windows share its order. `visitor` may be several columns, such as tenant and visitor.
    """
    w = Window.partitionBy(*_keys(visitor)).orderBy("_at", page)
    at = micros(time)
    rows = pages.filter(F.col(time).isNotNull()).withColumn("_at", at)
    starts = F.when(F.lag("_at").over(w).isNull() | (F.col("_at") - F.lag("_at").over(w) >= gap_micros), 1).otherwise(0)
    numbered = rows.withColumn("_start", starts).withColumn("session_number", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.withColumn("session_id", hash_key(*[F.col(c) for c in _keys(visitor)], F.col("session_number"))).drop("_start", "_at")


def session_rollup(sessions: DataFrame, visitor: str | list[str] = "visitor", time: str = "ts", page: str = "page_id", carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per session: first and last page, pages, start, end and seconds, and the first page's `carried` columns."""
    key = F.struct(F.col(time), F.col(page))
    rolled = sessions.groupBy(*_keys(visitor), "session_number", "session_id").agg(
        F.min_by(page, key).alias("first_page"), F.max_by(page, key).alias("last_page"), F.count("*").alias("n_pages"),
        F.min(time).alias("session_start"), F.max(time).alias("session_end"),
        *[F.min_by(c, key).alias(c) for c in carried],
    )
    seconds = F.floor((micros("session_end") - micros("session_start")) / 1_000_000)
    return rolled.withColumn("seconds", seconds.cast("bigint"))


def revision(old: DataFrame, new: DataFrame, key: str = "session_id") -> DataFrame:
    """What changed between two session tables: change is added, changed or removed (a tombstone)."""
    content = lambda df: df.select(F.col(key), F.sha2(F.to_json(F.struct(*[c for c in sorted(df.columns) if c != key])), 256).alias("h"))
    a, b = content(old).withColumnRenamed("h", "old_hash"), content(new).withColumnRenamed("h", "new_hash")
    change = F.when(F.col("old_hash").isNull(), "added").when(F.col("new_hash").isNull(), "removed").otherwise("changed")
    return a.join(b, key, "full").filter(~F.col("old_hash").eqNullSafe(F.col("new_hash"))).select(key, change.alias("change"))


def dirty_visitors(
    pages: DataFrame, since: int | None, built: DataFrame | None, visitor: str | list[str] = "visitor", ingested: str = "ingested_at", upto: int | None = None, click: str | None = None, changed: DataFrame | None = None
) -> DataFrame:
    """Visitors to rebuild: with pages ingested in (since, upto], or with pages but no built session.

    Also, if asked for: visitors who share a click id (`click`) with such a page, as the time it was first seen may move; visitors whose
    identity changed (`changed`); and, if built has n_pages, visitors whose built sessions hold another number of pages than there are.
    """
    new = pages.filter((F.col(ingested) > since) if since is not None else F.lit(True))
    if upto is not None:
        new = new.filter(F.col(ingested) <= upto)
    found = new.select(*_keys(visitor))
    if built is not None:
        found = found.unionByName(pages.select(*_keys(visitor)).join(built.select(*_keys(visitor)), _keys(visitor), "left_anti"))
        if "n_pages" in built.columns:
            there = pages.filter(F.col(ingested).isNotNull()).groupBy(*_keys(visitor)).agg(F.count("*").alias("_there"))
            held = built.groupBy(*_keys(visitor)).agg(F.sum("n_pages").alias("_held"))
            stale = held.join(there, _keys(visitor), "left").filter(~F.col("_there").eqNullSafe(F.col("_held")))
            found = found.unionByName(stale.select(*_keys(visitor)))
    if click is not None:
        clicked = new.filter(F.col(click).isNotNull()).select(click).distinct()
        found = found.unionByName(pages.join(clicked, click, "left_semi").select(*_keys(visitor)))
    if changed is not None:
        found = found.unionByName(changed.select(*_keys(visitor)))
    return found.distinct()
