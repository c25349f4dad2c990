"""One row per sensor and time bucket.

All samplers group by location, terminal, sensor and bucket, plus the columns in
``by`` (a day, a source table, a batch). Readings of a group are ordered by
``(time, rtime, seq)``; the remaining columns break ties when there is no ``seq``.

Every aggregate here has a partial form of fixed size, so each task hands at most
two rows per group to the shuffle. A group may hold any share of the input.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeflow.functions.channels import first_channel
from gaugeflow.functions.keys import time_bucket
from gaugeflow.schema import ORDER, SENSOR_KEY

GROUP = [*SENSOR_KEY, "bucket"]

LAST_PAIR = "last_pair"
MAX_LEVEL = "max_level"


def _required(name: str) -> Column:
    message = F.lit(f"reading without {name}")
    return F.coalesce(F.col(name), F.raise_error(message)).alias(name)


def bucketed(df: DataFrame, bucket_ms: int) -> DataFrame:
    """Add the bucket number. A reading without sensor key or time is an error."""
    complete = df.withColumns({name: _required(name) for name in [*SENSOR_KEY, "time"]})
    return complete.withColumn("bucket", time_bucket("time", bucket_ms))


def grouped_rows(
    df: DataFrame, bucket_ms: int, by: Sequence[str]
) -> tuple[DataFrame, list[str], list[str]]:
    """Bucketed rows, the columns to group them by, and the columns to return."""
    rows = bucketed(df, bucket_ms)
    keyed, keys = _with_hash(rows, [*by, *GROUP])
    return keyed, keys, rows.columns


def _with_hash(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Lead the grouping columns with their hash.

    Whole rows are combined by sorting. Site and device names differ little in their
    first bytes; with the hash in front nearly every comparison ends at a number.
    """
    return rows.withColumn("_hash", F.xxhash64(*keys)), ["_hash", *keys]


def ranked_columns(rows: DataFrame, keys: Sequence[str]) -> list[str]:
    """Non-key columns, those that decide the order first."""
    order = [c for c in ORDER if c in rows.columns]
    return order + [c for c in rows.columns if c not in keys and c not in order]


def unpacked(grouped: DataFrame, plain: Sequence[str], columns: list[str]) -> DataFrame:
    """``columns`` from the struct ``row``, but those in ``plain`` from beside it."""
    return grouped.select(*[F.col(c) if c in plain else F.col(f"row.{c}") for c in columns])


def earliest(df: DataFrame, bucket_ms: int, by: Sequence[str] = ()) -> DataFrame:
    """The reading with the smallest ``(time, rtime, seq)`` of each group."""
    rows, keys, columns = grouped_rows(df, bucket_ms, by)
    first = rows.groupBy(*keys).agg(F.min(F.struct(*ranked_columns(rows, keys))).alias("row"))
    return unpacked(first, keys, columns)


def _last_two(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row and the one before it, as structs ``last`` and ``prev``.

    The rank filter becomes a group limit on both sides of the shuffle.
    """
    fields = ranked_columns(rows, keys)
    ties = [] if "seq" in rows.columns else [c for c in fields if c not in ORDER]
    newest_first = [F.desc(c) for c in fields if c in ORDER] + [F.desc(c) for c in ties]
    window = W.partitionBy(*keys).orderBy(*newest_first)
    row = F.struct(*fields)
    return (
        rows.withColumn("_rank", F.row_number().over(window))
        .where("_rank <= 2")
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("_rank") == 1, row)).alias("last"),
            F.max(F.when(F.col("_rank") == 2, row)).alias("prev"),
        )
    )


def last_two(df: DataFrame, bucket_ms: int, by: Sequence[str] = ()) -> DataFrame:
    """The last two readings of each group, with their ``position`` from its end.

    All that the samplers need of a group's list of readings (:func:`group_list`).
    """
    rows, keys, columns = grouped_rows(df, bucket_ms, by)
    pairs = F.posexplode(F.filter(F.array("last", "prev"), lambda r: r.isNotNull()))
    listed = _last_two(rows, keys).select(*keys, pairs.alias("at", "row"))
    return unpacked(listed.withColumn("position", F.col("at").cast("bigint") + 1), [*keys, "position"], [*columns, "position"])


def group_list(df: DataFrame, bucket_ms: int, by: Sequence[str] = ()) -> DataFrame:
    """Every reading with its ``position`` in its group, from 1 in ``(time, rtime, seq)`` order.

    A group is sorted and numbered in one task, on disk if it is large; no list of it is held.
    """
    rows, keys, columns = grouped_rows(df, bucket_ms, by)
    fields = ranked_columns(rows, keys)
    ties = [] if "seq" in rows.columns else [c for c in fields if c not in ORDER]
    oldest_first = [F.asc_nulls_last(c) for c in [*(c for c in fields if c in ORDER), *ties]]
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*oldest_first)).cast("bigint")
    return rows.withColumn("position", position).select(*columns, "position")


def _chosen() -> Column:
    """The last row, unless the one before it has the higher alarm level."""
    return F.when(F.col("prev.level") > F.col("last.level"), F.col("prev")).otherwise(F.col("last"))


def _picked(rows: DataFrame, keys: Sequence[str], mode: str) -> DataFrame:
    """One ``row`` per group, as a struct of the non-key columns."""
    if mode == MAX_LEVEL:
        ranked = F.struct("level", *[c for c in ranked_columns(rows, keys) if c != "level"])
        return rows.groupBy(*keys).agg(F.max(ranked).alias("row"))
    if mode == LAST_PAIR:
        return _last_two(rows, keys).select(*keys, _chosen().alias("row"))
    raise ValueError(f"unknown mode {mode}")


def representative(
    df: DataFrame, bucket_ms: int, mode: str = LAST_PAIR, by: Sequence[str] = ()
) -> DataFrame:
    """The reading that stands for its group.

    ``last_pair`` looks at the last two readings only: the last one, unless the one
    before has the higher level. ``max_level`` takes the latest reading of the
    highest level in the whole group.
    """
    rows, keys, columns = grouped_rows(df, bucket_ms, by)
    return unpacked(_picked(rows, keys, mode), keys, columns)


# --- first-channel statistics -------------------------------------------------


def head_aggregates() -> list[Column]:
    v = first_channel("values", on_empty="null")
    return [
        F.max(v).alias("v_max"),
        F.min(v).alias("v_min"),
        F.sum(v.cast("double")).alias("v_sum"),
        F.count(v).alias("v_rows"),
        F.count(F.lit(1)).alias("n_rows"),
    ]


def head_values(on_empty: str) -> Column:
    """``[max, min, mean]`` from the columns of :func:`head_aggregates`."""
    mean = (F.col("v_sum") / F.col("v_rows")).cast("float")
    stats = F.array("v_max", "v_min", mean)
    if on_empty == "skip":
        return stats
    message = F.lit("reading without a first channel")
    return F.when(F.col("v_rows") < F.col("n_rows"), F.raise_error(message)).otherwise(stats)


def head_stats(
    df: DataFrame,
    bucket_ms: int,
    mode: str = LAST_PAIR,
    by: Sequence[str] = (),
    on_empty: str = "error",
) -> DataFrame:
    """The representative with ``values = [max, min, mean]`` of the first channel.

    In ``last_pair`` mode the two branches are joined on the grouping columns they
    are already partitioned by. The branch that picks the row leaves out
    ``values``, so a columnar source reads the wide column once.
    """
    rows, keys, columns = grouped_rows(df, bucket_ms, by)
    slim = rows.drop("values")
    if mode == MAX_LEVEL:
        ranked = F.struct("level", *[c for c in ranked_columns(slim, keys) if c != "level"])
        grouped = rows.groupBy(*keys).agg(F.max(ranked).alias("row"), *head_aggregates())
    else:
        stats = rows.groupBy(*keys).agg(*head_aggregates())
        grouped = _picked(slim, keys, mode).join(stats, keys)
    grouped = grouped.withColumn("values", head_values(on_empty))
    return unpacked(grouped, [*keys, "values"], columns)


# --- all channels -------------------------------------------------------------


def channel_stats(
    df: DataFrame,
    bucket_ms: int,
    mode: str = LAST_PAIR,
    by: Sequence[str] = (),
    on_ragged: str = "error",
) -> DataFrame:
    """The representative with max, min and mean of each of its channels, in turn.

    The representative decides how many channels there are. With ``on_ragged =
    "error"`` a shorter reading raises; with ``"skip"`` a channel is taken over
    the readings that have it. The list gathered per group has one entry per channel.
    """
    rows, keys, columns = grouped_rows(df, bucket_ms, by)
    channels = (
        exploded_channels(rows, keys)
        .groupBy(*keys, "channel")
        .agg(*channel_aggregates())
        .groupBy(*keys)
        .agg(*channel_list())
    )
    joined = _picked(rows, keys, mode).join(channels, keys)
    values = channel_values(F.size("row.values"), on_ragged)
    return unpacked(joined.withColumn("values", values), [*keys, "values"], columns)


def exploded_channels(rows: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """One row per channel; a reading without channels is one row whose channel is null."""
    return rows.select(*keys, *more, F.posexplode_outer("values").alias("channel", "v"))


def channel_aggregates() -> list[Column]:
    return [
        F.max("v").alias("v_max"),
        F.min("v").alias("v_min"),
        F.sum(F.col("v").cast("double")).alias("v_sum"),
        F.count(F.lit(1)).alias("n"),
    ]


def channel_list() -> list[Column]:
    """The channels of a group in order, and how many readings it has.

    A reading has either a first channel or the null one, so these two count the readings.
    """
    entry = F.struct("channel", "v_max", "v_min", "v_sum", "n")
    stands = F.coalesce(F.col("channel"), F.lit(0)) == 0
    return [
        F.sort_array(F.collect_list(F.when(F.col("channel").isNotNull(), entry))).alias("channels"),
        F.sum(F.when(stands, F.col("n")).otherwise(0)).alias("n_rows"),
    ]


def channel_values(width: Column, on_ragged: str) -> Column:
    """Statistics of the first ``width`` channels from ``channels`` and ``n_rows``."""
    used = F.slice("channels", F.lit(1), width)
    stats = F.flatten(
        F.transform(
            used,
            lambda c: F.array(c["v_max"], c["v_min"], (c["v_sum"] / c["n"]).cast("float")),
        )
    )
    if on_ragged == "skip":
        return stats
    ragged = F.exists(used, lambda c: c["n"] < F.col("n_rows"))
    message = F.lit("reading with fewer channels than the representative")
    return F.when(ragged, F.raise_error(message)).otherwise(stats)


# --- mergeable state ----------------------------------------------------------


def _kept_rows(rows: DataFrame, keys: Sequence[str], mode: str) -> DataFrame:
    """``last`` and ``prev``: all that later merges need to pick the representative.

    With ``max_level`` the reading of the highest level is ``last``, and there is no ``prev``.
    """
    if mode == LAST_PAIR:
        return _last_two(rows, keys)
    picked = _picked(rows, keys, mode).withColumnRenamed("row", "last")
    return picked.withColumn("prev", F.lit(None).cast(picked.schema["last"].dataType))


def _kept_again(state: DataFrame, keys: Sequence[str], mode: str) -> DataFrame:
    """:func:`_kept_rows` of the rows that several states have kept."""
    pairs = F.filter(F.array("last", "prev"), lambda r: r.isNotNull())
    return _kept_rows(state.select(*keys, F.inline(pairs)), keys, mode)


def sample_state(
    df: DataFrame, bucket_ms: int, by: Sequence[str] = (), mode: str = LAST_PAIR
) -> DataFrame:
    """Per group: the last two readings and the sums behind the first-channel statistics.

    States of disjoint inputs, or of finer buckets, merge into the state of their
    union (:func:`merge_states`); :func:`conditional_from_state` and
    :func:`head_from_state` turn a state into sampled rows.
    """
    rows, keys, _ = grouped_rows(df, bucket_ms, by)
    stats = rows.groupBy(*keys).agg(*head_aggregates())
    return _kept_rows(rows, keys, mode).join(stats, keys).drop("_hash")


def merge_states(
    state: DataFrame, factor: int = 1, by: Sequence[str] = (), mode: str = LAST_PAIR
) -> DataFrame:
    """Merge states of equal keys; ``factor`` buckets become one.

    ``state`` is read twice: write it out first (:func:`gaugeflow.session.write_out`).
    """
    coarse = state.withColumn("bucket", time_bucket("bucket", factor))
    coarse, keys = _with_hash(coarse, [*by, *GROUP])
    stats = coarse.groupBy(*keys).agg(
        F.max("v_max").alias("v_max"),
        F.min("v_min").alias("v_min"),
        F.sum("v_sum").alias("v_sum"),
        F.sum("v_rows").alias("v_rows"),
        F.sum("n_rows").alias("n_rows"),
    )
    return _kept_again(coarse, keys, mode).join(stats, keys).drop("_hash")


def _from_state(state: DataFrame, by: Sequence[str], values) -> DataFrame:
    keys = [*by, *GROUP]
    picked = state.withColumn("row", _chosen())
    fields = picked.schema["row"].dataType.fieldNames()
    picked = picked.withColumn("values", values(F.col("row.values")))
    others = [F.col(f"row.{c}") for c in fields if c != "values"]
    return picked.select(*keys, *others, "values")


def head_from_state(
    state: DataFrame, by: Sequence[str] = (), on_empty: str = "error"
) -> DataFrame:
    """Rows of :func:`head_stats` in ``last_pair`` mode."""
    return _from_state(state, by, lambda _: head_values(on_empty))


def conditional_from_state(
    state: DataFrame, by: Sequence[str] = (), on_empty: str = "error"
) -> DataFrame:
    """First-channel statistics where the representative has exactly one channel,
    else its values as they are."""
    return _from_state(
        state,
        by,
        lambda own: F.when(F.size(own) == 1, head_values(on_empty)).otherwise(own),
    )


def conditional_stats(
    df: DataFrame, bucket_ms: int, by: Sequence[str] = (), on_empty: str = "error"
) -> DataFrame:
    """The sampler of the day-table backfill."""
    return conditional_from_state(sample_state(df, bucket_ms, by), by, on_empty)


def earliest_state(df: DataFrame, bucket_ms: int) -> DataFrame:
    """Per group: the earliest reading, as the struct ``row``."""
    rows, keys, _ = grouped_rows(df, bucket_ms, ())
    first = rows.groupBy(*keys).agg(F.min(F.struct(*ranked_columns(rows, keys))).alias("row"))
    return first.drop("_hash")


def merge_earliest(state: DataFrame) -> DataFrame:
    rows, keys = _with_hash(state, GROUP)
    return rows.groupBy(*keys).agg(F.min("row").alias("row")).drop("_hash")


def channel_state(df: DataFrame, bucket_ms: int, mode: str = LAST_PAIR) -> DataFrame:
    """Per group: what picks the representative, and the sums of every channel."""
    rows, keys, _ = grouped_rows(df, bucket_ms, ())
    channels = exploded_channels(rows, keys).groupBy(*keys, "channel").agg(*channel_aggregates())
    sums = channels.groupBy(*keys).agg(*channel_list())
    return _kept_rows(rows, keys, mode).join(sums, keys).drop("_hash")


def merge_channels(state: DataFrame, mode: str = LAST_PAIR) -> DataFrame:
    """Merge states of equal keys. ``state`` is read three times."""
    rows, keys = _with_hash(state, GROUP)
    counts = rows.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"))
    merged = rows.select(*keys, F.inline("channels")).groupBy(*keys, "channel")
    merged = merged.agg(
        F.max("v_max").alias("v_max"),
        F.min("v_min").alias("v_min"),
        F.sum("v_sum").alias("v_sum"),
        F.sum("n").alias("n"),
    )
    lists = merged.groupBy(*keys).agg(channel_list()[0])
    kept = _kept_again(rows, keys, mode).join(counts, keys)
    none = F.array().cast(state.schema["channels"].dataType)
    return kept.join(lists, keys, "left").withColumn("channels", F.coalesce("channels", none)).drop("_hash")


def channels_from_state(state: DataFrame, on_ragged: str = "error") -> DataFrame:
    """Rows of :func:`channel_stats`."""
    return _from_state(state, (), lambda own: channel_values(F.size(own), on_ragged))


def earliest_from_state(state: DataFrame) -> DataFrame:
    """Rows of :func:`earliest`."""
    return state.select(*GROUP, "row.*")


@dataclass(frozen=True)
class MergeableSampler:
    """A sampler in three steps, so that groups can be put together from parts.

    ``partial`` takes readings and the bucket, ``merge`` the states of any parts, ``rows`` a
    merged state. The names say which options of the sampler each step takes.
    """

    partial: Callable[..., DataFrame]
    merge: Callable[..., DataFrame]
    rows: Callable[..., DataFrame]
    state_options: tuple[str, ...] = ()
    row_options: tuple[str, ...] = ()

    def state(self, df: DataFrame, bucket_ms: int, options: Mapping[str, str]) -> DataFrame:
        return self.partial(df, bucket_ms, **self._some(options, self.state_options))

    def sampled(self, states: DataFrame, options: Mapping[str, str]) -> DataFrame:
        merged = self.merge(states, **self._some(options, self.state_options))
        return self.rows(merged, **self._some(options, self.row_options))

    @staticmethod
    def _some(options: Mapping[str, str], names: tuple[str, ...]) -> dict[str, str]:
        return {name: options[name] for name in names if name in options}


MERGEABLE = {
    "earliest": MergeableSampler(earliest_state, merge_earliest, earliest_from_state),
    "head_stats": MergeableSampler(
        sample_state, merge_states, head_from_state, ("mode",), ("on_empty",)
    ),
    "channel_stats": MergeableSampler(
        channel_state, merge_channels, channels_from_state, ("mode",), ("on_ragged",)
    ),
    "conditional_stats": MergeableSampler(
        sample_state, merge_states, conditional_from_state, ("mode",), ("on_empty",)
    ),
}


def unsampled(df: DataFrame, bucket_ms: int, by: Sequence[str] = ()) -> DataFrame:
    """Every reading, with its bucket."""
    return bucketed(df, bucket_ms)


SAMPLERS = {
    "earliest": earliest,
    "head_stats": head_stats,
    "channel_stats": channel_stats,
    "conditional_stats": conditional_stats,
    "none": unsampled,
}
