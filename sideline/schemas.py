"""Fixed schemas of the fact and dimension tables.

The facts are read with these schemas (no inference, no footer scan on the
driver); ``tests/test_schemas.py`` checks that the load step produces
exactly them.  They are the columns of the source tables that the marts
use (the source carried more columns that no query reads).
"""

from pyspark.sql import types as T

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()


def _struct(*cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


HIST_SCHEDULES = _struct(
    ("game_id", _S), ("season", _I), ("game_type", _S), ("week", _I), ("gameday", _S),
    ("weekday", _S), ("gametime", _S), ("away_team", _S), ("away_score", _D),
    ("home_team", _S), ("home_score", _D), ("away_coach", _S), ("home_coach", _S),
)

HIST_WEEKLY = _struct(
    ("player_id", _S), ("player_name", _S), ("player_display_name", _S), ("position", _S),
    ("position_group", _S), ("recent_team", _S), ("season", _I), ("week", _I),
    ("season_type", _S), ("opponent_team", _S),
    ("completions", _I), ("attempts", _I), ("passing_yards", _D), ("passing_tds", _I),
    ("interceptions", _D), ("carries", _I), ("rushing_yards", _D), ("rushing_tds", _I),
    ("receptions", _I), ("targets", _I), ("receiving_yards", _D), ("receiving_tds", _I),
)

# One layout of the stored fact tables, from load over refresh to publish.
SLICE_LAYOUT = ("season", "week")
# What identifies a weekly row within the stored table.
WEEKLY_KEYS = ("player_id", "season", "week")

DIM_TEAM_HEAD_COACH = _struct(("season", _I), ("week", _I), ("team", _S), ("head_coach", _S))
DIM_TEAM_HEAD_COACH_KEYS = ("season", "week", "team")

DIM_TEAM_DIVISION = _struct(("season", _I), ("team", _S), ("conference", _S), ("division", _S))
DIM_TEAM_DIVISION_KEYS = ("season", "team")
