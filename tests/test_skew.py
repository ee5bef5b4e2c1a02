"""A hot key (one team with a third of all weekly rows) changes neither results nor plan shape."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from conftest import game, player
from sideline.operators import games as G
from sideline.operators import players as PL
from sideline.operators import ranks as R

TEAMS = ["H", "A", "B", "C", "D", "E"]


def skewed_rows(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        team = "H" if i % 3 == 0 else rnd.choice(TEAMS[1:])
        week = 1 + i % 4
        rows.append(player(f"00-{i:05d}", position="RB", group="RB", team=team, week=week,
                           opp=None, rushing_yards=float(rnd.randint(0, 40)), rushing_tds=rnd.randint(0, 1),
                           passing_yards=float(rnd.randint(0, 9))))
    return rows


def test_hot_team_results_match_brute_force(spark, schedules_of, weekly_of):
    rows = skewed_rows()
    sched = [game(f"g{w}{a}", week=w, home_team=h, away_team=a)
             for w in range(1, 5) for h, a in (("H", "A"), ("B", "C"), ("D", "E"))]
    hs, hw = schedules_of(sched), weekly_of(rows)
    base = {(r["week"], r["team"]): r for r in R.team_weekly_base(hw, hs).collect()}
    want = defaultdict(float)
    for r in rows:
        want[(r[7], r[5])] += r[16]
    for (week, team), r in base.items():
        assert r["off_rush_yards"] == want[(week, team)]
    tge = G.team_games_enriched(G.team_games(hs))
    pg = PL.player_games(hw, tge)
    rb = PL.position_stats(pg, "RB", ["season"])
    total = rb.agg(F.sum("rushing_yards"), F.sum("games")).first()
    assert total[0] == sum(r[16] for r in rows) and total[1] == len(rows)
    plan_df = PL.position_stats(pg, "RB")
    plan_df.write.format("noop").mode("overwrite").save()
    plan = plan_df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
