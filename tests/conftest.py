import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sideline.session import get_spark  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

SCHEDULE_DDL = ("game_id string, season int, game_type string, week int, gameday string, weekday string, "
                "gametime string, away_team string, away_score double, home_team string, home_score double, "
                "away_coach string, home_coach string")
WEEKLY_DDL = ("player_id string, player_name string, player_display_name string, position string, "
              "position_group string, recent_team string, season int, week int, season_type string, "
              "opponent_team string, completions int, attempts int, passing_yards double, passing_tds int, "
              "interceptions double, carries int, rushing_yards double, rushing_tds int, receptions int, "
              "targets int, receiving_yards double, receiving_tds int")


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="sideline-tests", shuffle_partitions=4)
    yield s
    s.stop()


def game(game_id="g1", season=2020, week=1, game_type="REG", gameday="2020-09-13", weekday="Sunday",
         gametime="13:00", away_team="A", away_score=10.0, home_team="H", home_score=20.0,
         away_coach=" Coach A ", home_coach="Coach H"):
    return (game_id, season, game_type, week, gameday, weekday, gametime, away_team, away_score,
            home_team, home_score, away_coach, home_coach)


def player(player_id="00-1", player_name="P.One", display="Player One", position="RB", group="RB",
           team="H", season=2020, week=1, season_type="REG", opp="A", completions=0, attempts=0,
           passing_yards=0.0, passing_tds=0, interceptions=0.0, carries=0, rushing_yards=0.0,
           rushing_tds=0, receptions=0, targets=0, receiving_yards=0.0, receiving_tds=0):
    return (player_id, player_name, display, position, group, team, season, week, season_type, opp,
            completions, attempts, passing_yards, passing_tds, interceptions, carries, rushing_yards,
            rushing_tds, receptions, targets, receiving_yards, receiving_tds)


@pytest.fixture
def schedules_of(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEDULE_DDL)


@pytest.fixture
def weekly_of(spark):
    return lambda rows: spark.createDataFrame(rows, WEEKLY_DDL)
