"""Named queries over the driver tables: ``QUERIES[name](spark, sf_dir)``.

Every query reads the two fact tables loaded from the driver's parquet
tables (``plans.warehouse``: derived by Spark from ``lineitem``, ``supplier``
and ``nation`` once per input and written to the checkpoint folder), builds
the marts lazily and returns a DataFrame; nothing is collected.  The keys
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline.operators import align as AL
from sideline.operators import maintain as MT
from sideline.operators import profile as PR
from sideline.operators.games import played, vs500_leaderboard
from sideline.operators.people import coach_map, qb_primary_game
from sideline.operators.players import join_loss
from sideline.plans import leaders as L
from sideline.plans import pipelines as PP
from sideline.plans import warehouse as WH
from sideline.plans.marts import Marts
from sideline.schemas import DIM_TEAM_DIVISION, DIM_TEAM_HEAD_COACH, DIM_TEAM_HEAD_COACH_KEYS, HIST_SCHEDULES, HIST_WEEKLY
from sideline.session import ensure_checkpoint_dir
from sideline.sources import fixtures as FX
from sideline.sources import io as IO

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the maintenance scenarios (FIXTURES.md, inputs table).
REFRESH_WEEKS = (1, 2, 3, 4)
REFRESH_WEEKS_WITH_ROWS = (1, 2, 3)
UPSERT_SPLIT_SEASON = 2000
TEAM_CARD = "NATION_1"
VS500_MIN_GAMES = 50
RANGE = (1994, 1996)
RANGE_MIN_GAMES = 1
READ_SEASONS = (1995, 1996)
READ_WEEKS = (1, 2)
SQL_PREFIX = "bound_"


def facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The loaded fact tables (derived from the driver tables once per input)."""
    return WH.facts(spark, sf_dir)


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir)[0]


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir)[1]


_MARTS: dict[tuple[int, str, str], Marts] = {}


def marts(spark: SparkSession, sf_dir: str) -> Marts:
    """The mart layer over the loaded facts of ``sf_dir``.

    The ``Marts`` object only holds lazy plans, so it is reused for the same
    session and loaded input (keyed by the load folder, which changes when
    the input changes); every query still executes in full.
    """
    key = (id(spark), spark.sparkContext.applicationId, WH.load_facts(spark, sf_dir))
    m = _MARTS.get(key)
    if m is None:
        if len(_MARTS) >= 16:
            _MARTS.clear()
        hs, hw = facts(spark, sf_dir)
        m = _MARTS[key] = Marts(hs, hw)
    return m


def _m(fn: Callable[[Marts], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(marts(spark, sf_dir))


# ---- maintenance scenarios -------------------------------------------------
def _latest_weeks(weekly: DataFrame, weeks) -> DataFrame:
    latest = weekly.agg(F.max("season").alias("season"))
    return latest.select("season", F.explode(F.array(*[F.lit(w) for w in weeks])).alias("week"))


def refresh_slices_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks 1-4 of the latest season replaced by new rows for weeks 1-3 (+1 yard)."""
    hw = weekly(spark, sf_dir)
    slices = _latest_weeks(hw, REFRESH_WEEKS)
    arriving = _latest_weeks(hw, REFRESH_WEEKS_WITH_ROWS)
    incoming = (hw.join(F.broadcast(arriving), ["season", "week"], "left_semi")
                .withColumns({c: F.col(c) + 1 for c in ("passing_yards", "rushing_yards", "receiving_yards")}))
    return MT.refresh_slices(hw, incoming, slices, few=True)


def upsert_coach_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = marts(spark, sf_dir)
    cm = m.coach_map
    target = cm.where(F.col("season") <= UPSERT_SPLIT_SEASON)
    incoming = (cm.where(F.col("season") >= UPSERT_SPLIT_SEASON)
                .withColumn("head_coach", F.concat(F.col("head_coach"), F.lit("_2"))))
    return MT.upsert(target, incoming, ["season", "week", "team"])


def upsert_division_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    hs = schedules(spark, sf_dir)
    target = FX.division_feed(spark, sf_dir, schedules=hs)
    changed = FX.division_feed(spark, sf_dir, shift=1, schedules=hs)
    latest = changed.agg(F.max("season").alias("season"))
    incoming = changed.join(F.broadcast(latest), "season", "left_semi")
    return MT.upsert(target, incoming, ["season", "team"])


def weekly_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly table as a newer feed would send it: other names, text keys, extras."""
    hw = weekly(spark, sf_dir)
    feed = hw.select(*[
        (F.when(F.col("player_name").isNull(), F.lit("x"))
         .when(F.col("player_name") == "", F.lit("3.0"))
         .otherwise(F.col("season").cast("string")).alias("season") if c == "season" else
         F.when(F.col("week") == 3, F.lit("3.0")).otherwise(F.col("week").cast("string")).alias("week")
         if c == "week" else F.col(c))
        for c in hw.columns])
    feed = feed.withColumnsRenamed({"recent_team": "team", "interceptions": "passing_interceptions"})
    return feed.withColumns({
        "sacks_suffered": (F.col("carries") % 3).cast("double"),
        "sack_yards_lost": (F.col("carries") % 7).cast("double"),
        "def_tackles": F.col("targets") % 4,
        "fg_made": F.when(F.col("attempts") > 5, F.col("attempts") - 5),
        "pacr_new": F.col("receptions").cast("double") / 2,
    })


def harmonize_weekly_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = weekly(spark, sf_dir).columns
    return AL.harmonize(weekly_feed(spark, sf_dir), target)


def schema_drift_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = weekly(spark, sf_dir).columns
    return AL.schema_drift(weekly_feed(spark, sf_dir), target)


def in_season_refresh_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed weeks of the latest season re-delivered by the feeds; rows per slice."""
    hs, hw = facts(spark, sf_dir)
    return PP.in_season_refresh(hs, hw, hs, weekly_feed(spark, sf_dir)).counts


def _wide_refresh(spark: SparkSession, sf_dir: str) -> PP.RefreshResult:
    """The same refresh on tables that have a column more than the fixed schemas, in table and feed."""
    hs, hw = facts(spark, sf_dir)
    hs = hs.withColumn("total", F.col("home_score") + F.col("away_score"))
    more = F.col("carries") + F.lit(0.5)
    return PP.in_season_refresh(hs, hw.withColumn("fantasy_points", more), hs,
                                weekly_feed(spark, sf_dir).withColumn("fantasy_points", more))


# ---- slices and ordered outputs ---------------------------------------------
def schedules_of_seasons_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IO.read_seasons(spark, f"{WH.load_facts(spark, sf_dir)}/hist_schedules", READ_SEASONS).select(*HIST_SCHEDULES.fieldNames())


def weekly_of_seasons_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = IO.read_seasons(spark, f"{WH.load_facts(spark, sf_dir)}/hist_weekly", READ_SEASONS, READ_WEEKS)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in HIST_WEEKLY.fields])


def check_keys_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = marts(spark, sf_dir)
    return MT.check_keys([
        ("hist_schedules.game_id", m.schedules, ["game_id"], []),
        ("hist_weekly.player_season_week", m.weekly, ["player_id", "season", "week"], []),
        ("dim_team_head_coach.pk", m.coach_map, ["season", "week", "team"], ["head_coach"]),
        ("v_team_games_enriched.season_week_team", m.team_games_enriched, ["season", "week", "team"], []),
        ("dim_team_division.pk", FX.division_feed(spark, sf_dir, schedules=m.schedules), ["season", "team"], []),
    ])


def row_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = marts(spark, sf_dir)
    return MT.row_counts({
        "hist_schedules": m.schedules,
        "hist_weekly": m.weekly,
        "v_team_games": m.team_games,
        "v_team_games_enriched": m.team_games_enriched,
        "v_qb_primary_game": m.qb_primary_game,
        "dim_team_head_coach": m.coach_map,
        "v_player_games": m.player_games,
        "player_join_loss": join_loss(m.weekly, m.team_games_enriched),
    })


def team_card(m: Marts, team: str = TEAM_CARD) -> DataFrame:
    return m.team_alltime_wide.where(F.col("team") == team)


# ---- stored tables: load, refresh and merge, read back --------------------------------
def _place(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _load(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The facts landed as files (one of them empty, one missing) and loaded from there; (folder, counts)."""
    hs, hw = facts(spark, sf_dir)
    landed, out = _place(spark, "landed"), _place(spark, "loaded")
    IO.write_table(hs, f"{landed}/{PP.LANDED['hist_schedules']}")
    IO.write_table(hw, f"{landed}/{PP.LANDED['hist_weekly']}")
    IO.write_table(hw.limit(0), f"{landed}/{PP.LANDED['hist_rosters_weekly']}")
    return out, PP.load_landed(spark, landed, out)


def landed_load_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir)[1]


def _update(spark: SparkSession, sf_dir: str) -> str:
    """Loaded tables after the in-season refresh from the feeds."""
    out, _ = _load(spark, sf_dir)
    hs, _hw = facts(spark, sf_dir)
    PP.refresh_tables(spark, out, hs, weekly_feed(spark, sf_dir))
    return out


def updated_weekly_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(HIST_WEEKLY).parquet(f"{_update(spark, sf_dir)}/hist_weekly").select(*HIST_WEEKLY.fieldNames())


def updated_rejects_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = spark.read.parquet(f"{_update(spark, sf_dir)}/rejected_weekly")
    return rejects.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in HIST_WEEKLY.fields])


def merged_coaches_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored coach dimension up to a season, and the rest merged into it, with new names."""
    m, path = marts(spark, sf_dir), f"{_place(spark, 'dims')}/dim_team_head_coach"
    renamed = m.coach_map.where(F.col("season") >= UPSERT_SPLIT_SEASON).withColumn("head_coach", F.concat(F.col("head_coach"), F.lit("_2")))
    for rows in (m.coach_map.where(F.col("season") <= UPSERT_SPLIT_SEASON), renamed):
        IO.merge_into(rows, path, DIM_TEAM_HEAD_COACH, DIM_TEAM_HEAD_COACH_KEYS, ("head_coach",))
    return spark.read.schema(DIM_TEAM_HEAD_COACH).parquet(path).select(*DIM_TEAM_HEAD_COACH.fieldNames())


def merged_divisions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two division files merged one after the other, the second with the latest season's changes."""
    hs, root = schedules(spark, sf_dir), _place(spark, "dims")
    changed = FX.division_feed(spark, sf_dir, shift=1, schedules=hs)
    latest = changed.agg(F.max("season").alias("season"))
    for k, rows in enumerate((FX.division_feed(spark, sf_dir, schedules=hs), changed.join(F.broadcast(latest), "season", "left_semi"))):
        path = IO.write_csv(rows.select(*DIM_TEAM_DIVISION.fieldNames()), f"{root}/divisions-{k}.csv")
        PP.merge_divisions(spark, root, path)
    return spark.read.schema(DIM_TEAM_DIVISION).parquet(f"{root}/dim_team_division").select(*DIM_TEAM_DIVISION.fieldNames())


def appended_batches_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored games appended season by season, the last season twice; rows of each batch."""
    hs, path = schedules(spark, sf_dir), f"{_place(spark, 'appended')}/games"
    seasons = [*READ_SEASONS, READ_SEASONS[-1]]
    for season in seasons:
        IO.append_batch(played(hs).where(F.col("season") == season), path, str(season))
    return spark.read.parquet(path).groupBy(F.col("batch").cast("int").alias("season")).agg(F.count(F.lit(1)).alias("rows"))


def play_by_play_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files of single seasons with differing columns, loaded as one dataset."""
    hw, landed, out = weekly(spark, sf_dir), _place(spark, "landed"), _place(spark, "loaded")
    for season in READ_SEASONS:
        rows = hw.where(F.col("season") == season).select("player_id", "week", *(["carries"] if season == READ_SEASONS[0] else ["targets"]))
        IO.write_table(rows, f"{landed}/pbp_{season}.parquet")
    PP.load_play_by_play(spark, landed, out, range(READ_SEASONS[0] - 2, READ_SEASONS[-1] + 3))
    plays = spark.read.parquet(f"{out}/play_by_play")
    return plays.groupBy("season").agg(F.count(F.lit(1)).alias("rows"), F.sum("carries").alias("carries"), F.sum("targets").alias("targets"))


def profile_merged_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly table's profile from stored seasons, one of them profiled again; is each distinct count within five percent?"""
    out, _ = _load(spark, sf_dir)
    hw = weekly(spark, sf_dir)
    PP.refresh_profiles(spark, out)
    merged = PP.refresh_profiles(spark, out, seasons=[READ_SEASONS[0]])
    names = [c for c in hw.columns if c != "season"]
    exact = hw.agg(*[F.count_distinct(c).alias(c) for c in names]).unpivot([], names, "column_name", "exact")
    close = F.abs(F.col("distinct_count") - F.col("exact")) * 20 <= F.col("exact")
    return merged.join(exact, "column_name").select("column_name", "type", "non_null", "nulls", "null_pct", "min", "max", "avg", "examples", close.alias("distinct_within_5_pct"))


# ---- SQL with bound parameters over the views -----------------------------------------
def _sql(spark: SparkSession, sf_dir: str, text: str, **args) -> DataFrame:
    marts(spark, sf_dir).register(SQL_PREFIX)
    return spark.sql(text.replace("v_", f"{SQL_PREFIX}v_"), args=args)


def sql_team_seasons_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, """
SELECT season, team, games, wins, win_pct FROM v_team_season_splits
WHERE team = :team AND season BETWEEN :first AND :last AND win_pct >= :least""", team=TEAM_CARD, first=RANGE[0], last=RANGE[1], least=0.1)


def sql_position_totals_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, """
SELECT position_group, is_primetime, COUNT(*) AS games, SUM(rushing_yards) AS rushing_yards FROM v_player_games
WHERE array_contains(:groups, position_group) AND rushing_yards > :yards AND season IN (SELECT explode(:seasons))
GROUP BY position_group, is_primetime""", groups=F.array(F.lit("RB"), F.lit("WR")), yards=50, seasons=F.array(*[F.lit(s) for s in READ_SEASONS]))


# ---- rows with gaps: what the facts at hand do not have ---------------------------------
def weekly_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly rows some of which have no position, no group, or a position that its group does not say."""
    position = F.when(F.col("carries") % 5 == 0, F.lit(None)).when(F.col("targets") % 4 == 1, F.lit("QB")).otherwise(F.col("position"))
    group = F.when(F.col("targets") % 4 == 0, F.lit(None)).otherwise(F.col("position_group"))
    return weekly(spark, sf_dir).withColumns({"position": position, "position_group": group})


def schedules_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schedule whose even weeks have each game twice, the second time with the coaches changed over."""
    hs = schedules(spark, sf_dir)
    again = hs.where(F.col("week") % 2 == 0).withColumns({"game_id": F.concat(F.lit("0_"), F.col("game_id")), "home_coach": F.col("away_coach"), "away_coach": F.col("home_coach")})
    return hs.unionByName(again)


def player_positions_gaps_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Marts(schedules(spark, sf_dir), weekly_with_gaps(spark, sf_dir))
    return m.player_games.select("player_id", "season", "week", "position", "position_group")


QUERIES: dict[str, Query] = {
    # sources
    "scan_schedules": schedules,
    "scan_weekly": weekly,
    # team games and splits
    "team_games": _m(lambda m: m.team_games),
    "team_season_record": _m(lambda m: m.team_season_record),
    "team_games_enriched": _m(lambda m: m.team_games_enriched),
    "team_alltime_splits": _m(lambda m: m.team_alltime_splits),
    "team_season_splits": _m(lambda m: m.team_season_splits),
    "team_last_season_splits": _m(lambda m: m.team_last_season_splits),
    "team_alltime_wide": _m(lambda m: m.team_alltime_wide),
    "team_last_season_wide": _m(lambda m: m.team_last_season_wide),
    "team_card": _m(team_card),
    "vs500_leaderboard": lambda s, d: vs500_leaderboard(schedules(s, d), VS500_MIN_GAMES),
    # quarterbacks and coaches
    "qb_primary_game": _m(lambda m: m.qb_primary_game),
    "qb_games": _m(lambda m: m.qb_games),
    "qb_alltime_splits": _m(lambda m: m.qb_alltime_splits),
    "qb_season_splits": _m(lambda m: m.qb_season_splits),
    "qb_last_season_splits": _m(lambda m: m.qb_last_season_splits),
    "coach_map": _m(lambda m: m.coach_map),
    "coach_games": _m(lambda m: m.coach_games),
    "coach_alltime_splits": _m(lambda m: m.coach_alltime_splits),
    "coach_season_splits": _m(lambda m: m.coach_season_splits),
    "coach_last_season_splits": _m(lambda m: m.coach_last_season_splits),
    # players
    "player_games": _m(lambda m: m.player_games),
    "rb_alltime_stats": _m(lambda m: m.position_alltime("RB")),
    "rb_season_stats": _m(lambda m: m.position_season("RB")),
    "rb_last_season_stats": _m(lambda m: m.position_last_season("RB")),
    "rb_rolling3": _m(lambda m: m.rolling3("RB")),
    "wr_alltime_stats": _m(lambda m: m.position_alltime("WR")),
    "wr_season_stats": _m(lambda m: m.position_season("WR")),
    "wr_last_season_stats": _m(lambda m: m.position_last_season("WR")),
    "wr_rolling3": _m(lambda m: m.rolling3("WR")),
    "te_alltime_stats": _m(lambda m: m.position_alltime("TE")),
    "te_season_stats": _m(lambda m: m.position_season("TE")),
    "te_last_season_stats": _m(lambda m: m.position_last_season("TE")),
    "te_rolling3": _m(lambda m: m.rolling3("TE")),
    "qb_stats_alltime": _m(lambda m: m.position_alltime("QB")),
    "qb_stats_season": _m(lambda m: m.position_season("QB")),
    "qb_stats_last_season": _m(lambda m: m.position_last_season("QB")),
    "qb_rolling3": _m(lambda m: m.rolling3("QB")),
    "rb_home_away_splits": _m(L.rb_home_away_top),
    # ranks
    "team_weekly_base": _m(lambda m: m.team_weekly_base),
    "team_weekly_ranks": _m(lambda m: m.team_weekly_ranks),
    "def_rank_by_pos": _m(lambda m: m.def_rank_by_pos),
    "player_games_keys": _m(lambda m: m.player_games_keys),
    "player_games_vs_def_rank": _m(lambda m: m.player_games_vs_def_rank),
    # leaderboards
    "top_teams_alltime": _m(L.top_teams_alltime),
    "top_teams_last_season": _m(L.top_teams_last_season),
    "top_qbs_alltime": _m(L.top_qbs_alltime),
    "top_qbs_last_season": _m(L.top_qbs_last_season),
    "top_coaches_alltime": _m(L.top_coaches_alltime),
    "rb_leaders_alltime": _m(L.rb_leaders_alltime),
    "rb_leaders_last_season": _m(L.rb_leaders_last_season),
    "rb_primetime_leaders": _m(L.rb_primetime_leaders),
    "rb_hot_last3": _m(L.rb_hot_last3),
    "wr_leaders_alltime": _m(L.wr_leaders_alltime),
    "te_leaders_alltime": _m(L.te_leaders_alltime),
    "qb_leaders_alltime": _m(L.qb_leaders_alltime),
    "qb_hot_last3": _m(L.qb_hot_last3),
    "def_rank_qb_top10": _m(L.def_rank_qb_top10),
    "scored_sample": lambda s, d: L.scored_sample(schedules(s, d)),
    "player_games_latest": _m(L.player_games_latest),
    # slices by season list and range, ordered outputs
    "schedules_of_seasons": schedules_of_seasons_q,
    "weekly_of_seasons": weekly_of_seasons_q,
    "vs500_leaderboard_range": lambda s, d: vs500_leaderboard(schedules(s, d), RANGE_MIN_GAMES, *RANGE),
    "scored_sample_range": lambda s, d: L.scored_sample(schedules(s, d), 10, *RANGE),
    "team_card_ordered": _m(L.teams_in_order),
    "games_by_season_tail": lambda s, d: L.last_seasons(PR.games_by_season(schedules(s, d))),
    "schedules_head_tail": lambda s, d: L.head_and_tail(schedules(s, d), ["season", "week", "game_id"]),
    "vs500_ordered": _m(lambda m: L.vs500_in_order(m, VS500_MIN_GAMES)),
    "team_last_season_wide_ordered": _m(L.teams_last_season_in_order),
    "profile_schedules_ordered": lambda s, d: L.numbered(PR.profile(schedules(s, d)), F.col("column_name")),
    "games_by_season_ordered": lambda s, d: L.numbered(PR.games_by_season(schedules(s, d)), F.col("season")),
    "weekly_rows_by_season_ordered": lambda s, d: L.numbered(PR.weekly_rows_by_season(weekly(s, d)), F.col("season")),
    # SQL with bound parameters
    "sql_team_seasons": sql_team_seasons_q,
    "sql_position_totals": sql_position_totals_q,
    # rows with gaps and repeats
    "player_positions_gaps": player_positions_gaps_q,
    "position_counts_gaps": lambda s, d: PR.position_counts(weekly_with_gaps(s, d)),
    "qb_primary_gaps": lambda s, d: qb_primary_game(weekly_with_gaps(s, d)),
    "coach_map_repeats": lambda s, d: coach_map(schedules_with_repeats(s, d), schedules_with_repeats(s, d)),
    # stored tables
    "landed_load": landed_load_q,
    "updated_weekly": updated_weekly_q,
    "updated_rejects": updated_rejects_q,
    "merged_coaches": merged_coaches_q,
    "merged_divisions": merged_divisions_q,
    "appended_batches": appended_batches_q,
    "play_by_play": play_by_play_q,
    # maintenance and alignment
    "refresh_slices": refresh_slices_q,
    "upsert_coach": upsert_coach_q,
    "upsert_division": upsert_division_q,
    "check_keys": check_keys_q,
    "row_counts": row_counts_q,
    "harmonize_weekly": harmonize_weekly_q,
    "schema_drift": schema_drift_q,
    "completed_weeks": lambda s, d: PR.completed_weeks(schedules(s, d)),
    "in_season_refresh": in_season_refresh_q,
    "refreshed_schedules": lambda s, d: _wide_refresh(s, d).schedules,
    "refreshed_weekly": lambda s, d: _wide_refresh(s, d).weekly,
    "rejected_weekly": lambda s, d: _wide_refresh(s, d).rejected_weekly,
    # profiles and coverage
    "profile_schedules": lambda s, d: PR.profile(schedules(s, d)),
    "profile_weekly": lambda s, d: PR.profile(weekly(s, d)),
    "profile_weekly_merged": profile_merged_q,
    "season_range": lambda s, d: PR.season_range(schedules(s, d)),
    "games_by_season": lambda s, d: PR.games_by_season(schedules(s, d)),
    "weekly_rows_by_season": lambda s, d: PR.weekly_rows_by_season(weekly(s, d)),
    "position_counts": lambda s, d: PR.position_counts(weekly(s, d)),
    "team_codes": lambda s, d: PR.team_codes(schedules(s, d)),
}
