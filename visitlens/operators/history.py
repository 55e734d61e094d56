"""Per-entity history features: recency, running counts, earlier scores, earlier and later dates.

Every feature is a counter or a shifted value inside some partition that contains the
entity column, so one shuffle on the entity serves all of them. Entities that hold a
large share of all rows are taken out of that shuffle and computed with ordered scans
that cut one entity over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.functions.calendar import days_between
from visitlens.operators.ordered import Counter, OrderedScan, Shift, add_features, order_key, over
from visitlens.operators.slices import nulls_last
from visitlens.operators.skew import HeavyKeys, find_heavy_keys
from visitlens.session import cut_lineage

#: A task sorts its rows once per order, and all these sorts count as its memory: some 7.5 KB a row for all features.
ROWS_PER_TASK = 50_000


@dataclass(frozen=True)
class Visits:
    """Column names of a visit table."""

    entity: str = "Patient_ID"
    group: str = "Health_Camp_ID"
    time: str = "Registration_Date"
    row_id: str = "row_id"

    @property
    def by_time(self) -> tuple[str, str]:
        return (self.time, self.row_id)

    @property
    def by_file(self) -> tuple[str]:
        return (self.row_id,)


@dataclass(frozen=True)
class Track:
    """Raw features that share a partition (entity plus ``within``) and an order."""

    within: tuple[str, ...]
    order: tuple[str, ...]
    features: tuple[Counter | Shift, ...]


@dataclass(frozen=True)
class Feature:
    """A history feature: the raw tracks it needs and the expression over them."""

    name: str
    result: Column
    tracks: tuple[Track, ...] = ()
    first_time: str | None = None
    across: tuple[str, tuple[str, ...]] | None = None


def _known(v: Visits, raw: str) -> Column:
    """A grouped value; rows without an entity belong to no group and get null."""
    return F.when(F.col(v.entity).isNotNull(), F.col(raw))


def time_since_last(v: Visits, name: str = "time_since_last_visit") -> Feature:
    """Days since the entity's previous visit; 0 for the first one and around null dates."""
    raw = Shift(f"_prev_{name}", v.time, 1)
    result = F.coalesce(days_between(_known(v, raw.name), F.col(v.time)), F.lit(0.0))
    return Feature(name, result, (Track((), v.by_time, (raw,)),))


def time_since_first(v: Visits, name: str = "time_since_first_visit") -> Feature:
    """Days since the entity's earliest visit."""
    first = f"_first_{name}"
    return Feature(name, days_between(_known(v, first), F.col(v.time)), first_time=first)


def visits_so_far(v: Visits, name: str = "visits_till_now") -> Feature:
    raw = Counter(f"_n_{name}")
    return Feature(name, _known(v, raw.name), (Track((), v.by_time, (raw,)),))


def visits_within(v: Visits, within: str, name: str, order: Sequence[str] | None = None) -> Feature:
    """Earlier visits of the entity with the same ``within`` value; null where that is null."""
    raw = Counter(f"_n_{name}")
    result = F.when(F.col(within).isNotNull(), _known(v, raw.name))
    return Feature(name, result, (Track((within,), tuple(order or v.by_time), (raw,)),))


def visits_same_time(v: Visits, name: str = "number_of_visits_today") -> Feature:
    """Earlier rows of the entity with the same time stamp."""
    return visits_within(v, v.time, name, v.by_file)


def earlier_value(
    v: Visits,
    value: str,
    k: int,
    name: str,
    order: Sequence[str] | None = None,
    only: tuple[str, str] | None = None,
) -> Feature:
    """The entity's value ``k`` rows earlier (later when negative).

    ``only=(column, level)`` looks among rows of that level and leaves the others null.
    The default order is the row id, i.e. the order of the source file.
    """
    raw = Shift(f"_at_{name}", value, k)
    track = Track((only[0],) if only else (), tuple(order or v.by_file), (raw,))
    known = _known(v, raw.name)
    result = known if only is None else F.when(F.col(only[0]) == only[1], known)
    return Feature(name, result, (track,))


def time_since_previous_row(v: Visits, order: Sequence[str], name: str) -> Feature:
    """Days since the previous row of the whole table sorted by entity and ``order``.

    The previous row may belong to another entity, which gives differences of either
    sign; 0 for the first row and around null dates.
    """
    order = tuple(order)
    inside, counter = Shift(f"_prev_{name}", v.time, 1), Counter(f"_n_{name}")
    across = f"_across_{name}"
    previous = F.when(F.col(counter.name) == 0, F.col(across)).otherwise(F.col(inside.name))
    result = F.coalesce(days_between(previous, F.col(v.time)), F.lit(0.0))
    return Feature(name, result, (Track((), order, (inside, counter)),), across=(across, order))


def add_history(
    df: DataFrame,
    features: Sequence[Feature],
    visits: Visits = Visits(),
    heavy: HeavyKeys | None = None,
    slices: int | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Append the features to ``df``.

    ``heavy`` names the entities to be split. ``source`` may be a cheaper frame with the
    same (entity, group, time, row id) rows, for what is looked up across entities.
    """
    if heavy is None:
        (heavy,) = find_heavy_keys(df, [visits.entity])
    tracks = _merge(features)
    firsts = [f.first_time for f in features if f.first_time]
    across = [
        _last_of_previous_entity(df if source is None else source, visits, *f.across) for f in features if f.across
    ]

    rest, hot = heavy.split(df) if heavy else (df, None)
    out = _plain(_spread(rest, heavy.rows, visits), tracks, firsts, visits)
    for table in across:
        out = out.join(table, visits.entity, "left")
    if heavy:
        split = _split(cut_lineage(hot), tracks, firsts, visits, slices)
        for table in across:
            split = _attach_small(split, heavy.split(table)[1], visits)
        out = out.unionByName(split)
    return out.select(*df.columns, *[f.result.alias(f.name) for f in features])


def _merge(features: Sequence[Feature]) -> list[Track]:
    """One track per partition and order."""
    merged: dict[tuple, dict[str, Counter | Shift]] = {}
    for feature in features:
        for track in feature.tracks:
            merged.setdefault((track.within, track.order), {}).update({f.name: f for f in track.features})
    return [Track(within, order, tuple(raw.values())) for (within, order), raw in merged.items()]


def _spread(df: DataFrame, rows: int | None, v: Visits) -> DataFrame:
    """``df`` by entity, in partitions of some ``ROWS_PER_TASK`` rows that Spark does not merge, however many rows there are.

    A table that would fill no more than one per core is left to Spark, which gives every core a part of it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = -(-(rows or 0) // ROWS_PER_TASK)
    return df.repartition(wanted, v.entity) if wanted > cores else df


def _plain(df: DataFrame, tracks: list[Track], firsts: list[str], v: Visits) -> DataFrame:
    """Plain windows on one shuffle by entity, with as few sorts as possible.

    A count within (entity, x) in order o is the position in (x, o) order less the
    position where x starts. Where the entity has features in (x, o) order anyway, the
    count shares their sort; otherwise it gets a partition of its own.
    """
    whole = {t.order: list(t.features) for t in tracks if not t.within}
    if firsts:
        whole.setdefault(v.by_time, [])
    shared = [t for t in tracks if t.within and (*t.within, *t.order) in whole and _only_counts(t)]
    for order, features in whole.items():
        window = Window.partitionBy(v.entity).orderBy(*nulls_last(order))
        guests = [t for t in shared if (*t.within, *t.order) == order]
        made = {name: F.first(v.time).over(window) for name in firsts if order == v.by_time}
        made |= {f.name: over(f, window) for f in [*features, *(f for t in guests for f in t.features)]}
        df = df.withColumns(made)
        for track in guests:
            start = F.rank().over(Window.partitionBy(v.entity).orderBy(*nulls_last(track.within))) - 1
            df = df.withColumns({f.name: F.col(f.name) - start for f in track.features})
    for track in tracks:
        if track.within and track not in shared:
            df = add_features(df, track.features, [v.entity, *track.within], track.order)
    return df


def _only_counts(track: Track) -> bool:
    return all(isinstance(f, Counter) for f in track.features)


def _split(
    hot: DataFrame, tracks: list[Track], firsts: list[str], v: Visits, slices: int | None
) -> DataFrame:
    out = hot
    if firsts:
        earliest = hot.groupBy(v.entity).agg(*[F.min(v.time).alias(name) for name in firsts])
        out = _attach_small(out, earliest, v)
    for track in tracks:
        out = OrderedScan(out, track.order, [v.entity, *track.within], slices).apply(track.features)
    return out


def _attach_small(df: DataFrame, table: DataFrame, v: Visits) -> DataFrame:
    """Join a table of one row per heavy entity, whose number is bounded by the heavy-key threshold."""
    key = f"_key_{v.entity}"
    named = table.withColumnRenamed(v.entity, key)
    return df.join(F.broadcast(named), F.col(v.entity).eqNullSafe(F.col(key)), "left").drop(key)


def _last_of_previous_entity(df: DataFrame, v: Visits, name: str, order: tuple[str, ...]) -> DataFrame:
    """For every entity, the time of the last row of the entity that sorts just before it."""
    last = cut_lineage(df.groupBy(v.entity).agg(F.max_by(v.time, order_key(order)).alias("_last")))
    return OrderedScan(last, [v.entity]).apply([Shift(name, "_last", 1)]).select(v.entity, name)
