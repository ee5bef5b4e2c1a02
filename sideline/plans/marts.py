"""The mart layer: named, lazy DataFrames built from the two fact tables.

``Marts(schedules, weekly)`` plays the role of the view schema: each property
is the DataFrame of one view, built on first use from the views it depends
on (same objects, so Catalyst sees one plan and reuses shared exchanges).
``register()`` exposes them as temp views for SQL users.  ``persist_bases()``
materialises the two wide bases (enriched team games, player games) when
many marts are read in one session; with ``checkpoint=True`` it also cuts
their lineage into the shared checkpoint folder (never a local checkpoint).
"""

from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from sideline.operators import games as G
from sideline.operators import people as P
from sideline.operators import players as PL
from sideline.operators import ranks as R
from sideline.operators import splits as S

POSITIONS = ("RB", "WR", "TE", "QB")


class Marts:
    def __init__(self, schedules: DataFrame, weekly: DataFrame,
                 coach_dim: DataFrame | None = None, coach_feed: DataFrame | None = None):
        self.schedules = schedules
        self.weekly = weekly
        self._coach_dim = coach_dim
        self._coach_feed = coach_feed

    @classmethod
    def from_tables(cls, spark: SparkSession, schedules_path: str, weekly_path: str) -> "Marts":
        """Marts over landed schedule and weekly tables (parquet files or folders).

        The weekly table may use the newer feed's column names (``team``,
        ``passing_interceptions``, ...); they are aligned first.  Extra
        columns are kept: the marts select what they use.
        """
        from sideline.operators.align import WEEKLY_RENAMES, rename_present
        schedules = spark.read.parquet(schedules_path)
        weekly = rename_present(spark.read.parquet(weekly_path), WEEKLY_RENAMES)
        return cls(schedules, weekly)

    # ---- team games -----------------------------------------------------
    @cached_property
    def team_games(self) -> DataFrame:
        return G.team_games(self.schedules)

    @cached_property
    def team_season_record(self) -> DataFrame:
        return G.season_record(self.team_games)

    @cached_property
    def team_games_enriched(self) -> DataFrame:
        return G.team_games_enriched(self.team_games)

    def last_season(self, df: DataFrame) -> DataFrame:
        return G.in_latest_season(df, self.schedules)

    @cached_property
    def team_alltime_splits(self) -> DataFrame:
        return S.record_splits(self.team_games_enriched, ["team"], S.TEAM_SPLITS)

    @cached_property
    def team_season_splits(self) -> DataFrame:
        return S.record_splits(self.team_games_enriched, ["season", "team"], S.TEAM_SPLITS)

    @cached_property
    def team_last_season_splits(self) -> DataFrame:
        return self.last_season(self.team_season_splits)

    @cached_property
    def team_alltime_wide(self) -> DataFrame:
        return S.record_splits(self.team_games_enriched, ["team"], S.TEAM_WIDE)

    @cached_property
    def team_last_season_wide(self) -> DataFrame:
        return S.record_splits(self.last_season(self.team_games_enriched), ["team"], S.TEAM_LAST_WIDE)

    # ---- quarterbacks and coaches ---------------------------------------
    @cached_property
    def qb_primary_game(self) -> DataFrame:
        return P.qb_primary_game(self.weekly)

    @cached_property
    def qb_games(self) -> DataFrame:
        return P.qb_games(self.team_games_enriched, self.qb_primary_game)

    @cached_property
    def qb_alltime_splits(self) -> DataFrame:
        return S.record_splits(self.qb_games, ["qb_id"], S.PERSON_ALLTIME, label=("qb_name", "qb_name"))

    @cached_property
    def qb_season_splits(self) -> DataFrame:
        return S.record_splits(self.qb_games, ["season", "qb_id"], S.PERSON_SEASON,
                               label=("qb_name", "qb_name"))

    @cached_property
    def qb_last_season_splits(self) -> DataFrame:
        return self.last_season(self.qb_season_splits)

    @cached_property
    def coach_map(self) -> DataFrame:
        feed = self._coach_feed if self._coach_feed is not None else self.schedules
        return P.coach_map(self.schedules, feed)

    @cached_property
    def coach_dim(self) -> DataFrame:
        return self._coach_dim if self._coach_dim is not None else self.coach_map

    @cached_property
    def coach_games(self) -> DataFrame:
        return P.coach_games(self.team_games_enriched, self.coach_dim)

    @cached_property
    def coach_alltime_splits(self) -> DataFrame:
        return S.record_splits(self.coach_games, ["head_coach"], S.PERSON_SEASON)

    @cached_property
    def coach_season_splits(self) -> DataFrame:
        return S.record_splits(self.coach_games, ["season", "head_coach"], S.PERSON_SEASON)

    @cached_property
    def coach_last_season_splits(self) -> DataFrame:
        return self.last_season(self.coach_season_splits)

    # ---- players ----------------------------------------------------------
    @cached_property
    def player_games(self) -> DataFrame:
        return PL.player_games(self.weekly, self.team_games_enriched, self.schedules)

    def position_alltime(self, group: str) -> DataFrame:
        return PL.position_stats(self.player_games, group, ["player_id"])

    def position_season(self, group: str) -> DataFrame:
        return PL.position_stats(self.player_games, group, ["season", "player_id"])

    def position_last_season(self, group: str) -> DataFrame:
        return self.last_season(self.position_season(group))

    def rolling3(self, group: str) -> DataFrame:
        return PL.rolling3(self.player_games, group)

    # ---- ranks --------------------------------------------------------------
    @cached_property
    def team_weekly_base(self) -> DataFrame:
        return R.team_weekly_base(self.weekly, self.schedules)

    @cached_property
    def team_weekly_ranks(self) -> DataFrame:
        return R.team_weekly_ranks(self.team_weekly_base)

    @cached_property
    def def_rank_by_pos(self) -> DataFrame:
        return R.weekly_def_ranks(PL.player_lines(self.weekly), self.team_games_enriched, self.schedules)

    @cached_property
    def player_games_keys(self) -> DataFrame:
        return R.player_games_keys(self.player_games)

    @cached_property
    def player_games_vs_def_rank(self) -> DataFrame:
        return R.player_games_vs_def_rank(self.player_games_keys, self.def_rank_by_pos, self.schedules)

    # ---- session helpers ------------------------------------------------
    def views(self) -> dict[str, DataFrame]:
        """Every view by its SQL name, in dependency order."""
        v = {
            "v_team_games": self.team_games,
            "v_team_season_record": self.team_season_record,
            "v_team_games_enriched": self.team_games_enriched,
            "v_team_alltime_splits": self.team_alltime_splits,
            "v_team_season_splits": self.team_season_splits,
            "v_team_last_season_splits": self.team_last_season_splits,
            "v_qb_primary_game": self.qb_primary_game,
            "v_qb_games": self.qb_games,
            "v_qb_alltime_splits": self.qb_alltime_splits,
            "v_qb_season_splits": self.qb_season_splits,
            "v_qb_last_season_splits": self.qb_last_season_splits,
            "v_coach_games": self.coach_games,
            "v_coach_alltime_splits": self.coach_alltime_splits,
            "v_coach_season_splits": self.coach_season_splits,
            "v_coach_last_season_splits": self.coach_last_season_splits,
            "v_player_games": self.player_games,
        }
        names = {"RB": "rb", "WR": "wr", "TE": "te"}
        for g in POSITIONS:
            if g == "QB":
                v["v_qb_stats_alltime"] = self.position_alltime(g)
                v["v_qb_stats_season"] = self.position_season(g)
                v["v_qb_stats_last_season"] = self.position_last_season(g)
                v["v_qb_rolling3"] = self.rolling3(g)
            else:
                n = names[g]
                v[f"v_{n}_alltime_stats"] = self.position_alltime(g)
                v[f"v_{n}_season_stats"] = self.position_season(g)
                v[f"v_{n}_last_season_stats"] = self.position_last_season(g)
                v[f"v_{n}_rolling3"] = self.rolling3(g)
        v.update({
            "v_team_weekly_base": self.team_weekly_base,
            "v_team_weekly_ranks": self.team_weekly_ranks,
            "v_def_rank_by_pos": self.def_rank_by_pos,
            "v_player_games_keys": self.player_games_keys,
        })
        return v

    def register(self, prefix: str = "") -> list[str]:
        """Create or replace a temp view per mart; returns the names."""
        self.schedules.createOrReplaceTempView(f"{prefix}hist_schedules")
        self.weekly.createOrReplaceTempView(f"{prefix}hist_weekly")
        names = []
        for name, df in self.views().items():
            df.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def columns_frame(self, prefix: str = "") -> DataFrame:
        """(view_name, ordinal, column_name, data_type) of every view.

        Metadata only (bounded by the schemas' width), built on the driver
        from the analysed plans; no data is read.
        """
        rows = [(prefix + name, i + 1, f.name, f.dataType.simpleString())
                for name, df in self.views().items() for i, f in enumerate(df.schema.fields)]
        return self.schedules.sparkSession.createDataFrame(
            rows, "view_name string, ordinal int, column_name string, data_type string")

    def persist_bases(self, checkpoint: bool = False) -> "Marts":
        """Keep the enriched games and player games for repeated reads.

        ``checkpoint=True`` writes them to ``spark.checkpoint.dir`` (a shared
        folder on a cluster), which also survives executor loss.
        """
        def keep(df: DataFrame) -> DataFrame:
            return df.checkpoint(eager=True) if checkpoint else df.persist(StorageLevel.MEMORY_AND_DISK)

        self.__dict__["team_games_enriched"] = keep(self.team_games_enriched)
        self.__dict__["player_games"] = keep(self.player_games)
        return self
