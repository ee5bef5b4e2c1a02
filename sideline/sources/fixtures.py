"""Driver tables -> the two fact frames and the dimension feeds.

The test data is a TPC-H-like star schema.  ``FIXTURES.md`` fixes how it maps
onto the contest warehouse: a nation is a team, a supplier is a player, a ship
month is a week and a ship year a season.  Everything here is a lazy
DataFrame plan over ``lineitem``, ``supplier`` and ``nation``, so its work
grows with the data.

Plan shape (what scales):

* ``lineitem`` is aggregated once per (supplier, year, month) *before* any
  join; partial aggregation collapses a hot supplier map-side, and the join
  with ``supplier`` then sees at most one row per supplier-month.
* Team totals per month come from that same aggregate (a supplier has one
  nation), so both facts derive from one frame (``player_months``); the load
  step (``plans.warehouse``) stages it once as a parquet table, so
  ``lineitem`` is scanned and aggregated once for both facts.
* Games come from the team-month aggregate (months x 25 rows, bounded by the
  calendar, not by data volume) in one more grouped aggregate; the weekly
  opponent is a computed code.  ``nation`` (25 rows) is the only broadcast
  side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping (FIXTURES.md section 2).
TEAMS = 25  # round-robin modulus = number of nations
WEEKDAY_BY_CODE = ["Sunday", "Monday", "Thursday", "Saturday", "Sunday", "Sunday", "Friday"]
GAMETIME_BY_CODE = ["13:00", "16:25", "20:20", "9:30", "", "TBD", "19:00", "15:00"]
POSITION_BY_CODE = ["QB", "RB", "WR", "TE", "FB"]
POSITION_GROUP_BY_CODE = ["QB", "RB", "WR", "TE", "RB"]
TD_QUANTITY = 40
INTERCEPTION_DISCOUNT = 0.09
SCORE_MODULUS = 30
COACH_NULL_MODULUS = 19
COACH_ID_MODULUS = 17


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _game_type(week):
    return (F.when(week <= 8, "REG").when(week == 9, "WC").when(week == 10, "DIV")
            .when(week == 11, "CON").otherwise("SB"))


def supplier_months(lineitem: DataFrame) -> DataFrame:
    """One row per (suppkey, season, week) with every per-player measure."""
    qty = F.col("l_quantity")
    flag = F.col("l_returnflag")
    open_ = F.col("l_linestatus") == "O"
    big = qty >= TD_QUANTITY

    def n(cond):
        return F.count_if(cond).cast("int")

    return (
        lineitem
        .select("l_suppkey", "l_quantity", "l_discount", "l_returnflag",
                "l_linestatus", "l_shipdate")
        .groupBy(F.col("l_suppkey").alias("suppkey"),
                 F.year("l_shipdate").alias("season"),
                 F.month("l_shipdate").alias("week"))
        .agg(
            F.count(F.lit(1)).alias("items"),
            n((flag == "A") & open_).alias("completions"),
            n(flag == "A").alias("attempts"),
            F.sum(F.when(flag == "A", qty)).cast("double").alias("passing_yards"),
            n((flag == "A") & big).alias("passing_tds"),
            n(F.col("l_discount") >= INTERCEPTION_DISCOUNT).cast("double").alias("interceptions"),
            n(flag == "R").alias("carries"),
            F.sum(F.when(flag == "R", qty)).cast("double").alias("rushing_yards"),
            n((flag == "R") & big).alias("rushing_tds"),
            n((flag == "N") & open_).alias("receptions"),
            n(flag == "N").alias("targets"),
            F.sum(F.when(flag == "N", qty)).cast("double").alias("receiving_yards"),
            n((flag == "N") & big).alias("receiving_tds"),
        )
    )


def player_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (supplier, season, week) measures with the supplier's name and nation.

    Both facts derive from this frame; the load step stages it once so
    ``lineitem`` is aggregated once for both.
    """
    supplier = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("suppkey"), "s_name", F.col("s_nationkey").alias("nk"))
    return supplier_months(read_table(spark, sf_dir, "lineitem")).join(supplier, "suppkey")


def team_months(player_months: DataFrame) -> DataFrame:
    """Rows shipped per (season, week, nation)."""
    return player_months.groupBy("season", "week", "nk").agg(F.sum("items").alias("items"))


def opponent_code(season, week, code):
    """Round-robin opponent of team ``code`` that week (itself = bye)."""
    return F.pmod(season * 12 + week - code + TEAMS, F.lit(TEAMS))


def _names(nation: DataFrame, key: str, name: str) -> DataFrame:
    return F.broadcast(nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name)))


def _coach(key, week, season):
    return F.when(F.pmod(key + week, F.lit(COACH_NULL_MODULUS)) == 0, F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit(" Coach_"),
                            F.pmod(key * 7 + season, F.lit(COACH_ID_MODULUS)).cast("string"),
                            F.lit(" ")))


def game_items(team_month: DataFrame) -> DataFrame:
    """(season, week, hk, ak, h_items, a_items): every round-robin game of every month.

    Each team-month row is exploded over the 25 team codes ``i`` (so every
    month with any shipment lists all of its games, played or not); every
    non-bye code ``i`` is paired with its opponent ``j``, and one grouped
    aggregate per game picks up each side's shipped rows (NULL if none).
    The input is the team-month aggregate, bounded by months x 25.
    """
    season, week = F.col("season"), F.col("week")
    i = F.col("i")
    j = opponent_code(season, week, i)
    lo, hi = F.least(i, j), F.greatest(i, j)
    home_first = F.pmod(lo + week, F.lit(2)) == 0
    codes = team_month.select("season", "week", "nk", "items",
                              F.explode(F.sequence(F.lit(0), F.lit(TEAMS - 1))).alias("i"))
    sides = (codes.where(i != j)
             .select("season", "week", "nk", "items", "i",
                     F.when(home_first, lo).otherwise(hi).alias("hk"),
                     F.when(home_first, hi).otherwise(lo).alias("ak")))
    own = F.col("nk") == i
    return sides.groupBy("season", "week", "hk", "ak").agg(
        F.max(F.when(own & (i == F.col("hk")), F.col("items"))).alias("h_items"),
        F.max(F.when(own & (i == F.col("ak")), F.col("items"))).alias("a_items"))


def hist_schedules(spark: SparkSession, sf_dir: str, months: DataFrame | None = None) -> DataFrame:
    """One row per game: the schedule fact table (game_id unique)."""
    nation = read_table(spark, sf_dir, "nation")
    pm = player_months(spark, sf_dir) if months is None else months
    g = (game_items(team_months(pm))
         .join(_names(nation, "hk", "home_team"), "hk")
         .join(_names(nation, "ak", "away_team"), "ak"))
    season, week, hk, ak = F.col("season"), F.col("week"), F.col("hk"), F.col("ak")
    ww = F.lpad(week.cast("string"), 2, "0")
    weekday = F.element_at(F.array(*[F.lit(d) for d in WEEKDAY_BY_CODE]), F.pmod(hk + week, F.lit(7)) + 1)
    gametime = F.element_at(F.array(*[F.lit(t) for t in GAMETIME_BY_CODE]),
                            F.pmod(hk * 5 + week * 3 + season, F.lit(8)) + 1)
    return g.select(
        F.concat(season.cast("string"), F.lit("_"), ww, F.lit("_"), F.col("away_team"),
                 F.lit("_"), F.col("home_team")).alias("game_id"),
        season.alias("season"),
        _game_type(week).alias("game_type"),
        week.alias("week"),
        F.concat(season.cast("string"), F.lit("-"), ww, F.lit("-"),
                 F.lpad((F.pmod(hk * 3 + week, F.lit(28)) + 1).cast("string"), 2, "0")).alias("gameday"),
        weekday.alias("weekday"),
        gametime.alias("gametime"),
        F.col("away_team"),
        F.pmod(F.col("a_items"), F.lit(SCORE_MODULUS)).cast("double").alias("away_score"),
        F.col("home_team"),
        F.pmod(F.col("h_items"), F.lit(SCORE_MODULUS)).cast("double").alias("home_score"),
        _coach(ak, week, season).alias("away_coach"),
        _coach(hk, week, season).alias("home_coach"),
    )


def hist_weekly(spark: SparkSession, sf_dir: str, months: DataFrame | None = None) -> DataFrame:
    """One row per (player, season, week): the weekly player fact table.

    The opponent is the round-robin partner of the player's team that month
    (a computed code, NULL in a bye week), so no join with the schedule.
    """
    nation = read_table(spark, sf_dir, "nation")
    pm = player_months(spark, sf_dir) if months is None else months
    ok = opponent_code(F.col("season"), F.col("week"), F.col("nk"))
    w = (pm.withColumn("ok", F.when(ok != F.col("nk"), ok))
         .join(_names(nation, "nk", "recent_team"), "nk")
         .join(_names(nation, "ok", "opponent_team"), "ok", "left"))
    key = F.col("suppkey")
    name_code = F.pmod(key, F.lit(10))
    pos_code = F.pmod(key, F.lit(5)).cast("int") + 1
    return w.select(
        F.concat(F.lit("00-"), F.lpad(key.cast("string"), 7, "0")).alias("player_id"),
        F.when(name_code == 0, F.lit("")).when(name_code == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("S."), key.cast("string"))).alias("player_name"),
        F.col("s_name").alias("player_display_name"),
        F.element_at(F.array(*[F.lit(p) for p in POSITION_BY_CODE]), pos_code).alias("position"),
        F.element_at(F.array(*[F.lit(p) for p in POSITION_GROUP_BY_CODE]), pos_code).alias("position_group"),
        "recent_team",
        "season",
        "week",
        F.when(F.col("week") <= 8, "REG").otherwise("POST").alias("season_type"),
        "opponent_team",
        "completions", "attempts", "passing_yards", "passing_tds", "interceptions",
        "carries", "rushing_yards", "rushing_tds",
        "receptions", "targets", "receiving_yards", "receiving_tds",
    )


def coach_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule feed the coach map is built from (keys plus both coaches)."""
    return hist_schedules(spark, sf_dir).select(
        "game_id", "season", "week", "game_type", "home_coach", "away_coach")


def division_feed(spark: SparkSession, sf_dir: str, shift: int = 0,
                  schedules: DataFrame | None = None) -> DataFrame:
    """(season, team, conference, division) for every team seen in a season.

    Conference is the nation's region, division the nation key mod 4 (shifted
    by ``shift`` to make a changed feed).  Pairs come from the schedule's own
    (season, team) rows, then two equi-joins with the 25-row nation and 5-row
    region tables.
    """
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    teams = (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
             .select(F.col("n_name").alias("team"), F.col("r_name").alias("conference"),
                     F.pmod(F.col("n_nationkey") + shift, F.lit(4)).cast("string").alias("division")))
    schedules = hist_schedules(spark, sf_dir) if schedules is None else schedules
    seen = (schedules
            .select("season", F.explode(F.array("home_team", "away_team")).alias("team"))
            .distinct())
    return (seen.join(F.broadcast(teams), "team")
            .select(F.col("season").cast("int").alias("season"), "team", "conference", "division"))
