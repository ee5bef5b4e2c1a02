"""Win/loss splits: one grouped aggregate of conditional sums per grouping.

Every split mart (team, QB, coach; all-time, per season, latest season; the
wide dashboard forms) is a configuration of ``record_splits``: grouping keys,
an optional label, and an ordered list of (measure, situation) pairs.  All
measures are computed in one hash aggregate with map-side partial
aggregation, so a hot group (one team with a third of all games) is combined
before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sideline.functions.exprs import flag_sum, ratio

# Situations: name -> condition on a team-game row.
SITUATIONS = {
    "home": lambda: F.col("is_home"),
    "away": lambda: ~F.col("is_home"),
    "primetime": lambda: F.col("is_primetime"),
    "morning": lambda: F.col("is_morning"),
    "afternoon": lambda: F.col("is_afternoon"),
    "evening": lambda: F.col("is_evening"),
    "playoff": lambda: F.col("is_playoff"),
    "regular": lambda: ~F.col("is_playoff"),
    "vs_500": lambda: F.col("opp_is_500_plus"),
}


@lru_cache(maxsize=None)
def _measure(kind: str, situation: str) -> Column:
    """One measure column (built once per process: Columns are immutable)."""
    cond = SITUATIONS[situation]()
    wp = F.col("win_pts")
    if kind == "games":
        expr = flag_sum(cond)
    elif kind == "wins":
        expr = flag_sum(cond & (wp == 1))
    elif kind == "wins_pts":
        expr = F.sum(F.when(cond, wp).otherwise(F.lit(0.0)))
    elif kind == "win_pct":
        expr = ratio(F.sum(F.when(cond, wp).otherwise(F.lit(0.0))), flag_sum(cond), 4)
    else:
        raise ValueError(f"unknown measure {kind!r}")
    return expr.alias(f"{kind}_{situation}")


@lru_cache(maxsize=None)
def _record_columns() -> tuple[Column, ...]:
    """games, wins, losses, ties, win_pct (4 dp, half-up on the exact ratio)."""
    wp = F.col("win_pts")
    return (
        F.count(F.lit(1)).alias("games"),
        flag_sum(wp == 1).alias("wins"),
        flag_sum(wp == 0).alias("losses"),
        flag_sum(wp == 0.5).alias("ties"),
        ratio(F.sum(wp), F.count(F.lit(1)), 4).alias("win_pct"),
    )


def record_columns() -> list[Column]:
    return list(_record_columns())


def record_splits(games: DataFrame, keys: Sequence[str],
                  measures: Sequence[tuple[str, str]],
                  label: tuple[str, str] | None = None) -> DataFrame:
    """Group ``games`` by ``keys``: the record plus the listed split measures.

    ``label=(out_name, column)`` adds ``MAX(column)`` as a display label.
    """
    cols: list[Column] = []
    if label is not None:
        cols.append(F.max(label[1]).alias(label[0]))
    cols += record_columns()
    cols += [_measure(kind, sit) for kind, sit in measures]
    return games.groupBy(*keys).agg(*cols)


def triple(*situations: str) -> list[tuple[str, str]]:
    """games, wins and win_pct for each situation, in that order."""
    return [(k, s) for s in situations for k in ("games", "wins", "win_pct")]


def pair(*situations: str) -> list[tuple[str, str]]:
    """games and wins for each situation."""
    return [(k, s) for s in situations for k in ("games", "wins")]


# Measure lists of the published marts.
TEAM_SPLITS = [
    ("wins", "home"), ("wins", "away"),
    ("wins", "primetime"), ("wins", "morning"), ("wins", "afternoon"),
    ("wins", "playoff"), ("wins", "regular"),
    ("games", "vs_500"), ("wins_pts", "vs_500"), ("wins", "vs_500"), ("win_pct", "vs_500"),
]
TEAM_WIDE = triple("home", "away", "primetime", "morning", "afternoon", "evening", "playoff", "vs_500")
TEAM_LAST_WIDE = (triple("home", "away") + pair("primetime", "playoff") + triple("vs_500"))
PERSON_ALLTIME = pair("home", "away", "primetime", "morning", "afternoon", "evening", "playoff", "vs_500")
PERSON_SEASON = pair("home", "away", "primetime", "playoff", "vs_500")
