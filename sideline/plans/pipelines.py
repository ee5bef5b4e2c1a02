"""Composite jobs: historical load and in-season refresh.

Both return lazy DataFrames (or write with Spark writers); nothing passes
through the driver except column names and the small week list logic, which
stays a DataFrame too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sideline.operators import align as AL
from sideline.operators import maintain as MT
from sideline.operators.games import played
from sideline.operators.profile import completed_weeks, merge_profiles, slice_profiles
from sideline.operators.people import coach_map
from sideline.schemas import (
    DIM_TEAM_DIVISION, DIM_TEAM_DIVISION_KEYS, DIM_TEAM_HEAD_COACH, DIM_TEAM_HEAD_COACH_KEYS, SLICE_LAYOUT, WEEKLY_KEYS,
)
from sideline.sources import io as IO


# Landed files of the historical load: table -> file below the landing folder.
LANDED = {"hist_schedules": "schedules.parquet", "hist_weekly": "weekly.parquet",
          "hist_rosters_seasonal": "rosters_seasonal.parquet", "hist_rosters_weekly": "rosters_weekly.parquet"}


# What identifies a row of a stored table, and what may not be NULL beside it.
KEYS = {"hist_schedules": (("game_id",), ("season", "week")), "hist_weekly": (WEEKLY_KEYS, ())}


def historical_load(frames: dict[str, DataFrame | None], out_dir: str,
                    partition_by: tuple[str, ...] = SLICE_LAYOUT, spark: SparkSession | None = None) -> DataFrame:
    """Replace each named table under ``out_dir`` (partitioned), then count it.

    Tables that are missing (None) are skipped and reported with NULL rows,
    like the source's loader.  Returns (table_name, rows) read back from the
    written files.  The layout is the one the refreshes rewrite; tables
    without a week are partitioned by season alone.  The facts' keys are
    checked in the pass that writes them: rows that repeat a key or lack a
    part of it are refused, and what was there stays.
    """
    written: dict[str, DataFrame | None] = {}
    for name, df in frames.items():
        if df is None:
            written[name] = None
            continue
        path = f"{out_dir.rstrip('/')}/{name}"
        parts = tuple(c for c in partition_by if c in df.columns)
        keys, not_null = KEYS.get(name, ((), ()))
        IO.replace_table(df.hint("rebalance", *parts) if parts and not keys else df, path, parts, keys, not_null)
        written[name] = df.sparkSession.read.parquet(path)
    return MT.row_counts(written, spark)


def load_landed(spark: SparkSession, landing_dir: str, out_dir: str) -> DataFrame:
    """The historical load from landed parquet files; missing and empty ones are skipped and reported with NULL rows."""
    frames = {name: IO.load_parquet(spark, f"{landing_dir.rstrip('/')}/{file}") for name, file in LANDED.items()}
    return historical_load(frames, out_dir, spark=spark)


def load_play_by_play(spark: SparkSession, landing_dir: str, out_dir: str, seasons) -> DataFrame:
    """One landed file per season (``pbp_<season>.parquet``) as one dataset partitioned by season.

    All seasons are one read (one scan, one job): the season is taken from
    each file's path, schemas are merged, so a column that only some seasons
    have is NULL in the others, and seasons without a file are not matched by
    the path pattern.  Returns (season, rows).
    """
    wanted = ",".join(str(int(s)) for s in seasons)
    try:
        plays = spark.read.option("mergeSchema", True).parquet(f"{landing_dir.rstrip('/')}/pbp_{{{wanted}}}.parquet")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "season int, rows bigint")
    season = F.regexp_extract(F.col("_metadata.file_path"), r"pbp_(\d+)\.parquet", 1).cast("int")
    path = f"{out_dir.rstrip('/')}/play_by_play"
    IO.replace_table(plays.withColumn("season", season).hint("rebalance", "season"), path, ("season",))
    return spark.read.parquet(path).groupBy("season").agg(F.count(F.lit(1)).alias("rows"))


@dataclass
class RefreshResult:
    schedules: DataFrame
    weekly: DataFrame
    slices: DataFrame
    counts: DataFrame
    rejected_weekly: DataFrame


def in_season_refresh(schedules: DataFrame, weekly: DataFrame,
                      feed_schedules: DataFrame, feed_weekly: DataFrame,
                      season: int | None = None, weeks: list[int] | None = None,
                      game_type: str = "REG") -> RefreshResult:
    """Refresh the current season's completed weeks in both fact tables.

    1. Weeks: the given list, else the weeks of ``season`` (default: the
       latest season of the feed) with a scored ``game_type`` game.
    2. Feed rows of those weeks (scored games of the type; weekly rows of the
       season type) replace the slices in both tables; every listed week is
       emptied first, even if nothing new arrived for it.
    3. Both feeds are conformed to the columns and types of the tables they
       go into, whatever columns those have.
    4. ``counts``: rows per refreshed slice in both new tables;
       ``rejected_weekly``: feed rows of no refreshed slice (for example a
       season that did not parse) or of another or no season type, kept for
       inspection instead of being dropped silently.
    """
    spark = weekly.sparkSession
    if weeks is None:
        # Resolved once (at most a season's weeks): every branch below then has a literal predicate.
        listed = [(r["season"], r["week"]) for r in completed_weeks(feed_schedules, season, game_type).collect()]
    elif season is None:
        raise ValueError("season is required with an explicit week list")
    else:
        listed = [(int(season), int(w)) for w in weeks]
    slices = spark.createDataFrame(listed, "season int, week int")
    new_sched, aligned = aligned_feeds(schedules.schema, weekly.schema, feed_schedules, feed_weekly, game_type)
    right = F.col("season_type").eqNullSafe(game_type)
    new_weekly = aligned.where(right)
    inside = F.coalesce(IO.in_slices(listed), F.lit(False))
    out_s = schedules.where(~inside).unionByName(new_sched.where(inside))
    out_w = weekly.where(~inside).unionByName(new_weekly.where(inside))
    counts = (MT.slice_counts(out_s, slices).withColumn("table_name", F.lit("hist_schedules"))
              .unionByName(MT.slice_counts(out_w, slices).withColumn("table_name", F.lit("hist_weekly")))
              .select("table_name", "season", "week", "rows"))
    rejected = aligned.where(~(right & inside))
    return RefreshResult(out_s, out_w, slices, counts, rejected)


def aligned_feeds(schedules: T.StructType, weekly: T.StructType, feed_schedules: DataFrame,
                  feed_weekly: DataFrame, game_type: str) -> tuple[DataFrame, DataFrame]:
    """Scored games of the type, and all weekly rows, with the columns and types of the tables they go into."""
    games = played(feed_schedules).where(F.col("game_type") == game_type)
    return (AL.conform(games, schedules),
            AL.conform(AL.harmonize(feed_weekly, weekly.fieldNames()), weekly))


def refresh_tables(spark: SparkSession, table_dir: str, feed_schedules: DataFrame, feed_weekly: DataFrame,
                   season: int | None = None, weeks: list[int] | None = None, game_type: str = "REG") -> DataFrame:
    """The in-season refresh of stored ``hist_schedules`` and ``hist_weekly`` below ``table_dir``.

    Same weeks and rows as ``in_season_refresh``.  Each feed is read once: it
    is aligned, split and staged in one pass (the games give the week list and
    the season it is of on the way), and both the refreshed partitions and the
    rejects come from there.  Only the partitions of the refreshed weeks are
    rewritten (the week list, at most a season's, is a literal predicate).
    Rows of no refreshed slice, or of another or no season type, are kept in
    ``rejected_weekly`` as a batch named after the weeks.  Rows that repeat a
    key, or lack a part of it, are refused while they are staged, before
    either table changes.  Running it again leaves the same tables.  Returns
    rows per table and slice, read back.
    """
    root = table_dir.rstrip("/")
    paths = {name: f"{root}/{name}" for name in ("hist_schedules", "hist_weekly")}
    stored = {name: spark.read.parquet(path) for name, path in paths.items()}
    for path in paths.values():
        IO.check_layout(spark, path, SLICE_LAYOUT)
    if weeks is not None and season is None:
        raise ValueError("season is required with an explicit week list")
    seen = Observation()
    games, lines = aligned_feeds(stored["hist_schedules"].schema, stored["hist_weekly"].schema,
                                 feed_schedules.observe(seen, F.max("season").cast("int").alias("season")), feed_weekly, game_type)
    with IO.staging(spark) as stage:
        games = stage(games, "games")
        if weeks is None:
            season = seen.get["season"] if season is None else season
            found = games.where(F.col("season") == season).select("week").distinct().collect()
            slices = sorted((int(season), r["week"]) for r in found if r["week"] is not None)
        else:
            slices = [(int(season), int(w)) for w in weeks]
        inside = F.coalesce(IO.in_slices(slices), F.lit(False))
        accepted = inside & F.col("season_type").eqNullSafe(game_type)
        lines = stage(lines.withColumn("_accepted", accepted), "lines", ("_accepted",))
        taken = {"hist_schedules": games.where(inside), "hist_weekly": lines.where("_accepted").drop("_accepted")}
        # Both are checked before either table changes.
        checked = {name: stage(MT.enforce(rows, *KEYS[name], what=name), name) for name, rows in taken.items()}
        for name, rows in checked.items():
            IO.overwrite_slices(rows, paths[name], slices, SLICE_LAYOUT)
        batch = "_".join([str(season), *(str(w) for _, w in slices)])
        IO.append_batch(lines.where("not _accepted").drop("_accepted"), f"{root}/rejected_weekly", batch)
    parts = [MT.slice_counts(spark.read.parquet(path), slices).select(F.lit(name).alias("table_name"), "season", "week", "rows")
             for name, path in paths.items()]
    return parts[0].unionByName(parts[1])


def refresh_profiles(spark: SparkSession, table_dir: str, name: str = "hist_weekly", seasons=None) -> DataFrame:
    """The stored profile of a table, kept season by season in ``<name>_profile``; returns the united profile.

    Only the named seasons are read and profiled anew (all, if none are named
    or nothing is stored yet): their partitions are replaced, the others are
    united from what is stored.
    """
    root = table_dir.rstrip("/")
    path = f"{root}/{name}_profile"
    if IO.partition_layout(spark, path) is None:
        seasons = None
    rows = IO.read_seasons(spark, f"{root}/{name}", seasons)
    part = slice_profiles(rows, ("season",))
    if seasons is None:
        IO.replace_table(part, path, ("season",))
    else:
        with IO.staging(spark) as stage:
            # A named season without rows loses its profile.
            gone = {int(s) for s in seasons} - {s for (s,) in IO.overwrite_partitions(stage(part, "profile"), path, ("season",))}
            IO.drop_partitions(spark, path, ("season",), [(s,) for s in sorted(gone)])
    return merge_profiles(spark.read.parquet(path))


def merge_divisions(spark: SparkSession, table_dir: str, csv_path: str) -> list[tuple]:
    """Upsert a division CSV into the stored ``dim_team_division``; returns the seasons it touched (none if there is no file)."""
    incoming = IO.read_csv_typed(spark, csv_path, DIM_TEAM_DIVISION)
    if incoming is None:
        return []
    return IO.merge_into(incoming, f"{table_dir.rstrip('/')}/dim_team_division", DIM_TEAM_DIVISION, DIM_TEAM_DIVISION_KEYS)


def merge_coaches(spark: SparkSession, table_dir: str, feed: DataFrame, seasons=None) -> list[tuple]:
    """Upsert the coach map of the stored schedule's played games (of some seasons) into ``dim_team_head_coach``; returns the seasons it touched."""
    root = table_dir.rstrip("/")
    games = IO.read_seasons(spark, f"{root}/hist_schedules", seasons)
    if seasons is not None:
        feed = feed.where(F.col("season").isin([int(s) for s in seasons]))
    return IO.merge_into(coach_map(games, feed), f"{root}/dim_team_head_coach", DIM_TEAM_HEAD_COACH, DIM_TEAM_HEAD_COACH_KEYS, ("head_coach",))


def load_division_mapping(spark, csv_path: str, current: DataFrame | None = None) -> DataFrame | None:
    """Upsert a division CSV (season,team,conference,division) into the dimension.

    Returns None when the file is missing (nothing to do), else the new
    dimension: ``current`` with every (season, team) of the file replaced or
    added.  A key repeated in the file fails the job.  The result is lazy:
    write it (``sources.io.write_table``) before the file is replaced.
    """
    incoming = IO.read_csv_typed(spark, csv_path, DIM_TEAM_DIVISION)
    if incoming is None:
        return None
    target = current if current is not None else spark.createDataFrame([], DIM_TEAM_DIVISION)
    return MT.upsert(target, incoming, list(DIM_TEAM_DIVISION_KEYS))


def refresh_coach_dimension(schedules: DataFrame, feed: DataFrame,
                            current: DataFrame | None = None) -> DataFrame:
    """Build the coach map of the played games and upsert it into the dimension.

    ``feed`` carries (game_id, season, week, game_type, home_coach,
    away_coach) and is matched one-to-one to the schedule.  The result is the
    new ``dim_team_head_coach`` (lazy; write it before replacing the input).
    """
    spark = schedules.sparkSession
    target = current if current is not None else spark.createDataFrame([], DIM_TEAM_HEAD_COACH)
    return MT.upsert(target, coach_map(schedules, feed), list(DIM_TEAM_HEAD_COACH_KEYS))
