"""Property tests: random inputs checked against brute-force Python references."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import game, player
from sideline.functions.exprs import ratio
from sideline.operators import games as G
from sideline.operators import maintain as MT
from sideline.operators import players as PL
from sideline.operators import splits as S

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
TEAMS = list("ABCDEF")


def half_up(fr: Fraction, places: int) -> float:
    d = Decimal(fr.numerator) / Decimal(fr.denominator)
    return float(d.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10 ** 6), st.integers(1, 10 ** 6)), min_size=1, max_size=20))
def test_ratio_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = [r[0] for r in df.select(ratio(F.col("n"), F.col("d"), 4)).collect()]
    assert got == [half_up(Fraction(n, d), 4) for n, d in pairs]


games_strategy = st.lists(
    st.tuples(st.sampled_from(TEAMS), st.sampled_from(TEAMS), st.integers(1, 12),
              st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 3)),
    min_size=1, max_size=25)


@SETTINGS
@given(games_strategy)
def test_team_splits_match_brute_force(schedules_of, rows):
    rows = [r for r in rows if r[0] != r[1]]
    if not rows:
        return
    sched = [game(f"g{i}", season=2020, week=w, away_team=a, home_team=h,
                  away_score=None if hs is None else float(as_), home_score=None if hs is None else float(hs))
             for i, (h, a, w, hs, as_) in enumerate(rows)]
    tge = G.team_games_enriched(G.team_games(schedules_of(sched)))
    got = {r["team"]: r for r in S.record_splits(tge, ["team"], S.TEAM_SPLITS).collect()}
    # brute force
    pts = defaultdict(list)
    for h, a, w, hs, as_ in rows:
        if hs is None:
            continue
        hp = Fraction(1, 2) if hs == as_ else Fraction(int(hs > as_))
        pts[h].append((hp, a, True))
        pts[a].append((1 - hp, h, False))
    season_pct = {t: sum(p for p, _, _ in v) / len(v) for t, v in pts.items()}
    assert set(got) == set(pts)
    for t, v in pts.items():
        r = got[t]
        wins = sum(1 for p, _, _ in v if p == 1)
        ties = sum(1 for p, _, _ in v if p == Fraction(1, 2))
        assert (r["games"], r["wins"], r["ties"]) == (len(v), wins, ties)
        assert r["wins"] + r["losses"] + r["ties"] == r["games"]
        assert r["win_pct"] == half_up(sum(p for p, _, _ in v) / len(v), 4)
        assert r["wins_home"] == sum(1 for p, _, home in v if p == 1 and home)
        vs = [p for p, o, _ in v if season_pct[o] >= Fraction(1, 2)]
        assert r["games_vs_500"] == len(vs)
        assert r["win_pct_vs_500"] == (half_up(sum(vs) / len(vs), 4) if vs else None)


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 8), st.integers(0, 50)), min_size=1, max_size=8,
                unique_by=lambda x: x[0]))
def test_rolling3_matches_brute_force(schedules_of, weekly_of, weeks):
    sched = [game(f"g{w}", week=w) for w in range(1, 9)]
    tge = G.team_games_enriched(G.team_games(schedules_of(sched)))
    hw = weekly_of([player(week=w, rushing_yards=float(y), rushing_tds=y % 3) for w, y in weeks])
    got = {r["week"]: r for r in PL.rolling3(PL.player_games(hw, tge), "RB").collect()}
    ordered = sorted(weeks)
    for i, (w, _) in enumerate(ordered):
        window = ordered[max(0, i - 2): i + 1]
        ys = [y for _, y in window]
        assert got[w]["yards_last3"] == float(sum(ys))
        assert got[w]["avg_yards_last3"] == sum(ys) / len(ys)
        assert got[w]["tds_last3"] == sum(y % 3 for y in ys)


@SETTINGS
@given(st.sets(st.integers(1, 6), max_size=6), st.sets(st.integers(1, 6), max_size=6))
def test_refresh_idempotent_and_exact(spark, listed, arriving):
    target = spark.createDataFrame([(2020, w, "old") for w in range(1, 7)], "season int, week int, v string")
    incoming = spark.createDataFrame([(2020, w, "new") for w in sorted(arriving)] or [],
                                     "season int, week int, v string")
    slices = [(2020, w) for w in listed]
    once = MT.refresh_slices(target, incoming, slices)
    twice = MT.refresh_slices(once, incoming, slices)
    want = sorted([(2020, w, "old") for w in range(1, 7) if w not in listed] +
                  [(2020, w, "new") for w in arriving if w in listed])
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, twice.collect())) == want


@SETTINGS
@given(st.lists(st.integers(-10 ** 6, 10 ** 6), min_size=1, max_size=12))
def test_round_avg_exact_on_fractional_values(spark, cents):
    # Values with two decimals (e.g. 1.005 is not one of them: 100ths only).
    from sideline.functions.exprs import round_avg
    vals = [c / 100 for c in cents]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.agg(round_avg("x", 3)).first()[0]
    exact = Fraction(sum(cents), 100 * len(cents))
    d = Decimal(exact.numerator) / Decimal(exact.denominator)
    want = float(d.quantize(Decimal("0.001"), rounding=ROUND_HALF_UP))
    assert got == want


def test_ratio_keeps_fractional_numerators(spark):
    df = spark.createDataFrame([(1.005, 1), (3.0055, 1), (2.5, 2)], "n double, d bigint")
    got = [r[0] for r in df.select(ratio(F.col("n"), F.col("d"), 3)).collect()]
    assert got == [1.005, 3.006, 1.25]
