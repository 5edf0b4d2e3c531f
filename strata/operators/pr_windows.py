"""Windows over the pull requests of one repository, whatever its size.

Every window runs within (group, slice). A group of few rows is one slice. A larger one is
cut by an ordering into slices of about equal size, and what a slice needs of those before it
is carried in:

* the number of earlier rows, so that row numbers go on, and the number of earlier rows equal
  to its first value, so that peers keep one rank across a border;
* the last rows before it, as context of the moving frame;
* the totals of the group.

Cuts come from a sample of the group's rows, and are part of the plan from then on: a row's
slice follows from its own values, so that a recomputed task gives the same rows. A group of
very many slices is cut level by level, so that neither a sample nor the cuts that a row is
compared with grow with the group. Each ordering then takes one exchange, on (group, slice).
What is carried is a row for each slice, and as many rows of context as the frame has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import partial, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from strata.functions.columns import hours_between
from strata.session import materialize, run_together

# Fixed value: rows before the current one in the "_50" columns, so a frame of 51 rows.
ROLLING_ROWS = 50

#: Rows of one group that a task sorts; larger groups are cut into slices of about this size.
SLICE_ROWS = 2_000_000
#: Sampled rows for each slice of a large group: slices differ in size by some tenths.
SAMPLED = 64
#: Slices that one cut makes of a group, at most; where more are due, each of them is cut again.
FAN = 256

_ID = "pull_request_id"


def _day_sizes() -> dict[str, Column]:
    """Sizes of a (repository, day): all pull requests, and those with a review."""
    return {"rows": F.count(F.lit(1)), "reviewed_pr_count": F.count("first_review_hours")}


def _speed() -> Column:
    """Sort key of the review speed: reviewed first, then hours ascending."""
    hours = F.col("first_review_hours")
    return F.struct(hours.isNull().alias("unreviewed"), hours.alias("hours"))


@dataclass(frozen=True)
class Slices:
    """An ordering of groups by (value, tiebreak), cut where groups are large.

    (value, tiebreak) must be unique within a group and ``value`` not NULL. ``cuts`` and
    ``carried`` are None where no group is large; then a group is its own slice.
    """

    name: str
    keys: tuple[str, ...]
    value: Column
    tiebreak: str
    #: A table for each level: the slice so far, and where it is cut again.
    cuts: tuple[DataFrame, ...] | None = None
    carried: DataFrame | None = None

    @property
    def column(self) -> str:
        return f"{self.name}_slice"

    @property
    def parts(self) -> list[str]:
        return [*self.keys, self.column] if self.cuts else [*self.keys]

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.parts)

    def assign(self, rows: DataFrame) -> DataFrame:
        """Adds the slice, from the row's own values: how many cuts are not behind them."""
        return reduce(self.assign_level, self.cuts, self.uncut(rows)) if self.cuts else rows

    def uncut(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(self.column, F.lit(0).cast("long"))

    def assign_level(self, rows: DataFrame, cuts: DataFrame) -> DataFrame:
        """The slices of the next level, in the order of those so far."""
        place = F.struct(self.value.alias("value"), F.col(self.tiebreak).alias("tiebreak"))
        slot = F.aggregate(
            F.array(*(F.lit(1 << bit) for bit in reversed(range((FAN - 1).bit_length())))),
            F.lit(0),
            lambda at, step: F.when(F.get("cuts", at + step - 1) <= place, at + step).otherwise(at),
        )
        cut = left_join(rows, cuts, [*self.keys, self.column])
        own = F.when(F.col("cuts").isNotNull(), slot).otherwise(0)
        return cut.withColumn(self.column, F.col(self.column) * FAN + own).drop("cuts")

    def carry(self, rows: DataFrame) -> DataFrame:
        """Adds what earlier slices hold; gone again after ``done``."""
        return left_join(rows, self.carried, [*self.keys, self.column]) if self.carried else rows

    def _carried(self, name: str) -> Column:
        return F.coalesce(F.col(f"{self.name}_{name}"), F.lit(0)) if self.carried else F.lit(0)

    def row_number(self) -> Column:
        """What ``row_number`` over the whole group gives."""
        ordered = self.window.orderBy(self.value, self.tiebreak)
        return F.row_number().over(ordered).cast("long") + self._carried("before")

    def percent_rank(self) -> Column:
        """What ``percent_rank`` by the value alone gives over the whole group."""
        local = F.rank().over(self.window.orderBy(self.value)).cast("long")
        # The first value of a slice may have come in earlier ones.
        rank = local + self._carried("before") - F.when(local == 1, self._carried("equal")).otherwise(0)
        rows = self.total("rows", F.count(F.lit(1)))
        return F.when(rows > 1, (rank - 1) / (rows - 1)).otherwise(0.0)

    def total(self, name: str, aggregate: Column) -> Column:
        """An aggregate over the whole group; ``name`` is what ``cut`` calls it."""
        own = aggregate.over(self.window)
        return F.coalesce(F.col(f"{self.name}_all_{name}"), own) if self.carried else own

    def done(self, rows: DataFrame) -> DataFrame:
        carried = self.carried.columns if self.carried else ()
        return rows.drop(self.column, *(c for c in carried if c not in self.keys))


def _same(keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(k).eqNullSafe(F.col(f"same_{k}")) for k in keys))


def left_join(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on equal keys; NULL is a key like any other.

    ``table`` is at rest, so Spark knows its bytes: a short one is sent to the rows, a longer
    one joined by sort-merge, where partitions that a large group skews are split.
    """
    renamed = table.withColumnsRenamed({k: f"same_{k}" for k in keys})
    return rows.join(renamed, _same(keys), "left").drop(*(f"same_{k}" for k in keys))


def cut(
    rows: DataFrame,
    name: str,
    keys: Sequence[str],
    value: Column,
    tiebreak: str,
    slice_rows: int,
    totals: dict[str, Column] | None = None,
) -> Slices:
    """Find the large groups of ``rows``, their cuts, and what each slice is to carry.

    A group is cut into ``FAN`` slices at most, and where it is due more, each of these is a
    group of the next level. A sample, sorted as one row, is so ``FAN`` times ``SAMPLED`` rows
    at most, whatever the group's size.
    """
    whole = Slices(name, tuple(keys), value, tiebreak)
    parts = [*keys, whole.column]
    todo, large, levels = whole.uncut(rows), None, []
    while True:
        sizes = todo.groupBy(*parts).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > slice_rows)
        sizes = materialize(sizes, f"{name}-large")
        most = sizes.agg(F.max("n")).first()[0]
        if not most:
            break
        slices = F.least(F.ceil(F.col("n") / slice_rows), F.lit(FAN)).cast("int")
        members = _of_groups(todo, sizes.withColumn("slices", slices), parts)
        levels.append(materialize(_cuts(members, whole, len(levels)), f"{name}-cuts"))
        large = members.drop("n", "slices", whole.column) if large is None else large
        if most <= FAN * slice_rows:
            break
        capped = sizes.where(F.col("n") > FAN * slice_rows).drop("n")
        todo = whole.assign_level(_of_groups(todo, capped, parts), levels[-1])
    if not levels:
        return whole
    cut_only = replace(whole, cuts=tuple(levels))
    return replace(cut_only, carried=_carry(cut_only.assign(large), cut_only, totals or {}))


def _of_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of some groups, with what ``groups`` tells of theirs."""
    renamed = groups.withColumnsRenamed({k: f"same_{k}" for k in keys})
    return rows.join(renamed, _same(keys)).drop(*(f"same_{k}" for k in keys))


def _cuts(members: DataFrame, whole: Slices, level: int) -> DataFrame:
    """The places that cut each group of ``n`` rows into ``slices``, by a sample of it."""
    parts = [*whole.keys, whole.column]
    seed = F.lit(f"cut{level or ''}")
    draw = F.pmod(F.xxhash64(whole.tiebreak, seed), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sampled = members.where(draw < F.col("slices") * SAMPLED / F.col("n"))
    place = F.struct(whole.value.alias("value"), F.col(whole.tiebreak).alias("tiebreak"))
    listed = sampled.groupBy(*parts).agg(
        F.max("slices").alias("slices"), F.sort_array(F.collect_list(place)).alias("sample")
    )
    ends = F.transform(
        F.sequence(F.lit(1), F.col("slices") - 1),
        lambda i: F.get("sample", F.floor(i * F.size("sample") / F.col("slices")).cast("int")),
    )
    return listed.select(*parts, ends.alias("cuts"))


def _carry(sliced: DataFrame, slices: Slices, totals: dict[str, Column]) -> DataFrame:
    """A row for each slice: rows before, equal rows before, totals of the group."""
    name, parts = slices.name, slices.parts
    by_value = sliced.groupBy(*parts, slices.value.alias("value")).agg(
        F.count(F.lit(1)).alias("n"), *(c.alias(f"t_{k}") for k, c in totals.items())
    )
    by_slice = by_value.groupBy(*parts).agg(
        F.sum("n").alias("n"),
        F.min("value").alias("first_value"),
        F.max("value").alias("last_value"),
        F.max_by("n", "value").alias("n_last"),
        *(F.sum(f"t_{k}").alias(f"t_{k}") for k in totals),
    )
    group = Window.partitionBy(*slices.keys)
    ordered = group.orderBy(slices.column)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    # Equal values lie in neighbouring slices: those that end with the value of the last one.
    ending = Window.partitionBy(*slices.keys, "last_value").orderBy(slices.column)
    so_far = by_slice.withColumn("n_ending", F.sum("n_last").over(ending))
    goes_on = F.lag("last_value").over(ordered) == F.col("first_value")
    carried = so_far.select(
        *parts,
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(f"{name}_before"),
        F.when(goes_on, F.lag("n_ending").over(ordered)).otherwise(0).alias(f"{name}_equal"),
        F.col("n").alias(f"{name}_own"),
        F.sum("n").over(group).alias(f"{name}_all_rows"),
        *(F.sum(f"t_{k}").over(group).alias(f"{name}_all_{k}") for k in totals),
    )
    return materialize(carried, f"{name}-carried")


def _context(sliced: DataFrame, slices: Slices, reach: int) -> DataFrame:
    """The last ``reach`` rows before each slice, under that slice's number.

    A slice hands its own last rows on to the next one, and to those after it where slices
    are shorter than the frame.
    """
    name, column = slices.name, slices.column
    end = F.col(f"{name}_before") + F.col(f"{name}_own")
    by_end = Window.partitionBy(*slices.keys).orderBy("end")
    listed = slices.carried.withColumn("end", end).withColumns(
        {
            "target": F.lead(column).over(by_end),
            "sources": F.collect_list(column).over(by_end.rangeBetween(1 - reach, 0)),
        }
    )
    feeds = listed.select(
        *slices.keys, "target", F.col("end").alias("target_start"), F.explode("sources").alias("source")
    )
    feeds = materialize(feeds.where("target IS NOT NULL"), f"{name}-feeds")
    latest = slices.window.orderBy(slices.value.desc(), F.desc(slices.tiebreak))
    tails = slices.carry(sliced).where(F.col(f"{name}_own").isNotNull())
    tails = tails.withColumn("from_end", F.row_number().over(latest)).where(F.col("from_end") <= reach)
    position = F.col(f"{name}_before") + F.col(f"{name}_own") - F.col("from_end") + 1
    fed = tails.withColumn("position", position).join(
        feeds.withColumnsRenamed({k: f"same_{k}" for k in slices.keys}),
        _same(slices.keys) & (F.col(column) == F.col("source")),
    )
    near = fed.where(F.col("position") > F.col("target_start") - reach)
    others = [F.col(c) for c in sliced.columns if c != column]
    return near.select(*others, F.col("target").alias(column))


# --- the windows -----------------------------------------------------------------------


def opening_windows(prs: DataFrame, slices: Slices | None = None) -> DataFrame:
    """Previous opening, gap to it and moving 51-row count / mean, in order of opening."""
    slices = slices or Slices("opening", ("repo_name",), F.col("opened_at"), _ID)
    rows = slices.assign(prs)
    ordered = slices.window.orderBy(slices.value, slices.tiebreak)
    frame = ordered.rowsBetween(-ROLLING_ROWS, Window.currentRow)
    if slices.carried:
        context = _context(rows, slices, ROLLING_ROWS).withColumn("is_context", F.lit(True))
        rows = rows.withColumn("is_context", F.lit(False)).unionByName(context)
    windows = rows.withColumns(
        {
            "prev_opened_at": F.lag("opened_at").over(ordered),
            "rolling_pr_count_50": F.count(F.lit(1)).over(frame),
            "rolling_avg_first_review_hours_50": F.avg("first_review_hours").over(frame),
        }
    )
    if slices.carried:
        windows = windows.where("NOT is_context").drop("is_context", slices.column)
    return windows.withColumn("pr_gap_hours", hours_between("prev_opened_at", "opened_at"))


def speed_windows(
    prs: DataFrame, repo: Slices | None = None, day: Slices | None = None
) -> DataFrame:
    """Rank and percent rank by hours to the first review, unreviewed last.

    Row numbers break ties by id. The percent rank has none to break: equal hours are
    peers and share it. The day's sizes place a rank within its (repository, day).
    """
    repo = repo or Slices("speed", ("repo_name",), _speed(), _ID)
    day = day or Slices("daily", ("repo_name", "dt"), _speed(), _ID)
    rows = repo.carry(repo.assign(prs))
    ranked = rows.withColumns(
        {
            "repo_review_speed_rank": repo.row_number(),
            "repo_review_speed_percent_rank": repo.percent_rank(),
        }
    )
    rows = day.carry(day.assign(repo.done(ranked)))
    counted = rows.withColumns(
        {
            "daily_review_speed_rank": day.row_number(),
            **{f"day_{name}": day.total(name, size) for name, size in _day_sizes().items()},
        }
    )
    return day.done(counted.withColumnRenamed("day_rows", "day_pr_count"))


def has_large_repo(pr_events: DataFrame, slice_rows: int) -> bool:
    """Whether any repository has more than ``slice_rows`` openings, an upper bound of its
    pull requests. The scan reads three narrow columns."""
    opened = pr_events.where("action = 'opened' AND pull_request_id IS NOT NULL")
    counts = opened.groupBy("repo_name").agg(F.count(F.lit(1)).alias("openings"))
    return not counts.where(F.col("openings") > slice_rows).isEmpty()


#: What is computed over pull requests, and the orderings that it needs.
WINDOWS = {"opening": ["opening"], "speed": ["speed", "daily"]}


def all_windows(
    prs: DataFrame, wanted: Sequence[str] = tuple(WINDOWS), found: dict[str, Slices] | None = None
) -> DataFrame:
    """The wanted windows, within slices where some were found."""
    found = found or {}
    if "opening" in wanted:
        prs = opening_windows(prs, found.get("opening"))
    if "speed" in wanted:
        prs = speed_windows(prs, found.get("speed"), found.get("daily"))
    return prs


def sliced_windows(
    prs: DataFrame, slice_rows: int, wanted: Sequence[str] = tuple(WINDOWS)
) -> DataFrame:
    """The wanted windows over pull requests at rest, groups above ``slice_rows`` cut."""
    reviewed = {"reviewed_pr_count": F.count("first_review_hours")}
    orderings = {
        "opening": (["repo_name"], F.col("opened_at"), {}),
        "speed": (["repo_name"], _speed(), {}),
        "daily": (["repo_name", "dt"], _speed(), reviewed),
    }
    found: dict[str, Slices] = {}

    def find(name: str) -> None:
        keys, value, totals = orderings[name]
        found[name] = cut(prs, name, keys, value, _ID, slice_rows, totals)

    run_together(partial(find, name) for window in wanted for name in WINDOWS[window])
    return all_windows(prs, wanted, found)
