"""Look-back along a timeline, safe when one entity owns most rows.

A plain window would send all rows of an entity to one task. Here every window
covers a bounded group, which gets the state of the earlier groups from their
summaries:

- rows with the same entity, time and id range (so at most ``IDS_PER_RANGE`` rows) are
  summarized, map-side;
- the summaries of an entity are split into hours: one window runs within each hour,
  one over the hours, of which there are as many as the timeline has;
- the rows get the state before their group, and a window within the group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

IDS_PER_RANGE = 1_000_000

_UNIX_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _hour(time: str) -> Column:
    """Number of the hour, rising with time, whatever the session's time zone."""
    since = F.col(time) - F.expr(_UNIX_EPOCH)
    return since.cast("interval hour").cast("long")


def _look_back(
    df: DataFrame,
    entity: str,
    time: str,
    row_id: str,
    state: Column,
    summary: Callable[[str, Column], Column],
    before: Callable[[str, Window], Column],
    merged: Callable[[Column, Column], Column],
    out: str,
) -> DataFrame:
    """Add ``out``: the state each row's entity has reached before it, by time, then id.

    ``summary(state, position)`` is the state that a set of rows leaves,
    ``before(state, window)`` the state before a row of an ordered window, and
    ``merged(near, far)`` puts a state together with an earlier one.
    """
    rows = df.withColumns(
        {"_state": state, "_range": F.expr(f"{row_id} div {IDS_PER_RANGE}")}
    )
    groups = (
        rows.groupBy(entity, time, "_range")
        .agg(summary("_state", F.col(row_id)).alias("_left"))
        .withColumn("_hour", _hour(time))
    )
    same_hour = Window.partitionBy(entity, "_hour").orderBy(time, "_range")
    placed = groups.withColumns(
        {"_near": before("_left", same_hour), "_last": F.lead("_range").over(same_hour).isNull()}
    )
    hours = placed.where("_last").select(
        entity, "_hour", merged(F.col("_left"), F.col("_near")).alias("_left")
    )
    earlier_hours = hours.select(
        entity, "_hour",
        before("_left", Window.partitionBy(entity).orderBy("_hour")).alias("_far"),
    )
    earlier = placed.join(earlier_hours, [entity, "_hour"]).select(
        entity, time, "_range", merged(F.col("_near"), F.col("_far")).alias("_far")
    )
    same_group = Window.partitionBy(entity, time, "_range").orderBy(row_id)
    return (
        rows.join(earlier, [entity, time, "_range"])
        .withColumn("_near", before("_state", same_group))
        .select(*df.columns, merged(F.col("_near"), F.col("_far")).alias(out))
    )


def running_max_before(
    df: DataFrame, entity: str, time: str, row_id: str, value: str, out: str
) -> DataFrame:
    """Add ``out``: the greatest ``value`` among the entity's earlier rows."""
    return _look_back(
        df, entity, time, row_id,
        state=F.col(value),
        summary=lambda state, position: F.max(state),
        before=lambda state, window: F.max(state).over(
            window.rowsBetween(Window.unboundedPreceding, -1)
        ),
        merged=lambda near, far: F.greatest(near, far),
        out=out,
    )


def previous_values(
    df: DataFrame, entity: str, time: str, row_id: str, values: dict[str, str]
) -> DataFrame:
    """Add, for each ``{out: column}``, the column's value in the entity's preceding row."""
    return _look_back(
        df, entity, time, row_id,
        state=F.struct(*[F.col(c).alias(out) for out, c in values.items()]),
        summary=lambda state, position: F.max_by(state, position),
        before=lambda state, window: F.lag(state).over(window),
        merged=lambda near, far: F.coalesce(near, far),
        out="_previous",
    ).select(*df.columns, "_previous.*")
