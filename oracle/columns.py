"""What the oracle computes for each mart, written out on its own.

Nothing here is read from the library: a wrong mapping there must turn its
row red.  The names are fixed values (the reports' output columns).
"""

# Output column -> DuckDB condition under which a game counts.
SITUATION = {
    "home": "is_home", "away": "NOT is_home", "primetime": "is_primetime", "morning": "is_morning",
    "afternoon": "is_afternoon", "evening": "is_evening", "playoff": "is_playoff",
    "regular": "NOT is_playoff", "vs_500": "opp_is_500_plus",
}

# Split columns of each mart, as written in its output.
SPLITS = {
    "team": "wins_home wins_away wins_primetime wins_morning wins_afternoon wins_playoff wins_regular "
            "games_vs_500 wins_pts_vs_500 wins_vs_500 win_pct_vs_500",
    "team wide": "games_home wins_home win_pct_home games_away wins_away win_pct_away "
                 "games_primetime wins_primetime win_pct_primetime games_morning wins_morning win_pct_morning "
                 "games_afternoon wins_afternoon win_pct_afternoon games_evening wins_evening win_pct_evening "
                 "games_playoff wins_playoff win_pct_playoff games_vs_500 wins_vs_500 win_pct_vs_500",
    "team last wide": "games_home wins_home win_pct_home games_away wins_away win_pct_away "
                      "games_primetime wins_primetime games_playoff wins_playoff "
                      "games_vs_500 wins_vs_500 win_pct_vs_500",
    "person": "games_home wins_home games_away wins_away games_primetime wins_primetime "
              "games_playoff wins_playoff games_vs_500 wins_vs_500",
    "person all time": "games_home wins_home games_away wins_away games_primetime wins_primetime "
                       "games_morning wins_morning games_afternoon wins_afternoon games_evening wins_evening "
                       "games_playoff wins_playoff games_vs_500 wins_vs_500",
}

# Position marts: output column -> SQL over the player games.  REAL(x) is a sum
# of yards, INT(x) a sum of counts, MEAN(x) an average to three places.
POSITION = {
    "RB": {
        "total_yards": "REAL(scrimmage_yards)", "rushing_yards": "REAL(rushing_yards)",
        "receiving_yards": "REAL(receiving_yards)", "rushing_attempts": "INT(rushing_attempts)",
        "targets": "INT(targets)", "total_tds": "INT(skill_tds)", "avg_yards_per_game": "MEAN(scrimmage_yards)",
        "tds_primetime": "INT(skill_tds) is_primetime", "yards_primetime": "REAL(scrimmage_yards) is_primetime",
        "tds_playoff": "INT(skill_tds) is_playoff", "yards_playoff": "REAL(scrimmage_yards) is_playoff",
    },
    "REC": {
        "receiving_yards": "REAL(receiving_yards)", "receptions": "INT(receptions)", "targets": "INT(targets)",
        "receiving_tds": "INT(receiving_tds)", "total_yards": "REAL(scrimmage_yards)",
        "avg_rec_yards_per_game": "MEAN(receiving_yards)",
        "tds_primetime": "INT(receiving_tds) is_primetime", "yards_primetime": "REAL(receiving_yards) is_primetime",
        "tds_playoff": "INT(receiving_tds) is_playoff", "yards_playoff": "REAL(receiving_yards) is_playoff",
    },
    "QB": {
        "passing_yards": "REAL(passing_yards)", "completions": "INT(completions)", "attempts": "INT(attempts)",
        "passing_tds": "INT(passing_tds)", "interceptions": "INT(interceptions)",
        "rushing_yards": "REAL(rushing_yards)", "total_yards_qb": "REAL(qb_total_yards)",
        "avg_pass_yards_per_game": "MEAN(passing_yards)",
        "passing_tds_primetime": "INT(passing_tds) is_primetime",
        "passing_yards_primetime": "REAL(passing_yards) is_primetime",
        "passing_tds_playoff": "INT(passing_tds) is_playoff",
        "passing_yards_playoff": "REAL(passing_yards) is_playoff",
    },
}
MART_OF = {"RB": "RB", "WR": "REC", "TE": "REC", "QB": "QB"}

# Rolling marts: (summed yards, their mean, summed touchdowns) and what they are of.
ROLLING = {
    "RB": ("yards_last3", "avg_yards_last3", "tds_last3", "scrimmage_yards", "skill_tds"),
    "REC": ("rec_yards_last3", "avg_rec_yards_last3", "rec_tds_last3", "receiving_yards", "receiving_tds"),
    "QB": ("pass_yards_last3", "avg_pass_yards_last3", "pass_tds_last3", "passing_yards", "passing_tds"),
}

# Columns of the leaderboards.
PERSON_REPORT = ("games wins losses ties win_pct games_home wins_home games_away wins_away "
                 "games_primetime wins_primetime games_playoff wins_playoff games_vs_500 wins_vs_500").split()
REPORT = {
    "teams": "team games wins losses ties win_pct".split(),
    "qbs": ["qb_id", "qb_name", *PERSON_REPORT],
    "coaches": ["head_coach", *PERSON_REPORT],
    "rbs": ("player_id player_name games total_yards rushing_yards receiving_yards rushing_attempts targets "
            "total_tds avg_yards_per_game").split(),
    "receivers": ("player_id player_name games receiving_yards receptions targets receiving_tds total_yards "
                  "avg_rec_yards_per_game").split(),
    "passers": ("player_id player_name games passing_yards completions attempts passing_tds interceptions "
                "rushing_yards total_yards_qb avg_pass_yards_per_game passing_tds_primetime").split(),
}

# Parameters of the registered scenarios.
CARD_TEAM = "NATION_1"
LEAST_GAMES_VS_500 = 50
EMPTIED_WEEKS = (1, 2, 3, 4)
REFILLED_WEEKS = (1, 2, 3)
SPLIT_SEASON = 2000
