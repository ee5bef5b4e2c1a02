"""DuckDB SQL for the fixture facts (FIXTURES.md section 2).

``FIXTURE_CTES`` defines ``hist_schedules`` and ``hist_weekly`` as CTEs over
the driver's pre-registered views (``lineitem``, ``supplier``, ``nation``,
``region``).  Every oracle query starts with it.
"""

FIXTURE_CTES = r"""
sm AS (
  SELECT l_suppkey AS suppkey,
         CAST(year(l_shipdate) AS INTEGER) AS season,
         CAST(month(l_shipdate) AS INTEGER) AS week,
         count(*) AS items,
         CAST(count(*) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'O') AS INTEGER) AS completions,
         CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS INTEGER) AS attempts,
         CAST(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS DOUBLE) AS passing_yards,
         CAST(count(*) FILTER (WHERE l_returnflag = 'A' AND l_quantity >= 40) AS INTEGER) AS passing_tds,
         CAST(count(*) FILTER (WHERE l_discount >= 0.09) AS DOUBLE) AS interceptions,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS INTEGER) AS carries,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS DOUBLE) AS rushing_yards,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R' AND l_quantity >= 40) AS INTEGER) AS rushing_tds,
         CAST(count(*) FILTER (WHERE l_returnflag = 'N' AND l_linestatus = 'O') AS INTEGER) AS receptions,
         CAST(count(*) FILTER (WHERE l_returnflag = 'N') AS INTEGER) AS targets,
         CAST(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS DOUBLE) AS receiving_yards,
         CAST(count(*) FILTER (WHERE l_returnflag = 'N' AND l_quantity >= 40) AS INTEGER) AS receiving_tds
  FROM lineitem
  GROUP BY 1, 2, 3
),
pm AS (
  SELECT sm.*, s.s_name, s.s_nationkey AS nk
  FROM sm JOIN supplier s ON s.s_suppkey = sm.suppkey
),
tm AS (
  SELECT season, week, nk, sum(items) AS items FROM pm GROUP BY 1, 2, 3
),
slot AS (
  SELECT season, week, i, (season * 12 + week - i + 25) % 25 AS j
  FROM (SELECT season, week, unnest(range(0, 25)) AS i FROM (SELECT DISTINCT season, week FROM tm) w) x
),
pair AS (
  SELECT season, week,
         CASE WHEN (i + week) % 2 = 0 THEN i ELSE j END AS hk,
         CASE WHEN (i + week) % 2 = 0 THEN j ELSE i END AS ak
  FROM slot WHERE i < j
),
hist_schedules AS (
  SELECT
    CAST(p.season AS VARCHAR) || '_' || lpad(CAST(p.week AS VARCHAR), 2, '0') || '_' || na.n_name || '_' || nh.n_name AS game_id,
    p.season AS season,
    CASE WHEN p.week <= 8 THEN 'REG' WHEN p.week = 9 THEN 'WC' WHEN p.week = 10 THEN 'DIV'
         WHEN p.week = 11 THEN 'CON' ELSE 'SB' END AS game_type,
    p.week AS week,
    CAST(p.season AS VARCHAR) || '-' || lpad(CAST(p.week AS VARCHAR), 2, '0') || '-'
      || lpad(CAST(1 + (p.hk * 3 + p.week) % 28 AS VARCHAR), 2, '0') AS gameday,
    CASE (p.hk + p.week) % 7 WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Thursday'
         WHEN 3 THEN 'Saturday' WHEN 4 THEN 'Sunday' WHEN 5 THEN 'Sunday' ELSE 'Friday' END AS weekday,
    CASE (p.hk * 5 + p.week * 3 + p.season) % 8 WHEN 0 THEN '13:00' WHEN 1 THEN '16:25'
         WHEN 2 THEN '20:20' WHEN 3 THEN '9:30' WHEN 4 THEN '' WHEN 5 THEN 'TBD'
         WHEN 6 THEN '19:00' ELSE '15:00' END AS gametime,
    na.n_name AS away_team,
    CAST(ta.items % 30 AS DOUBLE) AS away_score,
    nh.n_name AS home_team,
    CAST(th.items % 30 AS DOUBLE) AS home_score,
    CASE WHEN (p.ak + p.week) % 19 = 0 THEN NULL
         ELSE ' Coach_' || CAST((p.ak * 7 + p.season) % 17 AS VARCHAR) || ' ' END AS away_coach,
    CASE WHEN (p.hk + p.week) % 19 = 0 THEN NULL
         ELSE ' Coach_' || CAST((p.hk * 7 + p.season) % 17 AS VARCHAR) || ' ' END AS home_coach
  FROM pair p
  JOIN nation nh ON nh.n_nationkey = p.hk
  JOIN nation na ON na.n_nationkey = p.ak
  LEFT JOIN tm th ON th.season = p.season AND th.week = p.week AND th.nk = p.hk
  LEFT JOIN tm ta ON ta.season = p.season AND ta.week = p.week AND ta.nk = p.ak
),
hist_weekly AS (
  SELECT
    '00-' || lpad(CAST(pm.suppkey AS VARCHAR), 7, '0') AS player_id,
    CASE pm.suppkey % 10 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'S.' || CAST(pm.suppkey AS VARCHAR) END AS player_name,
    pm.s_name AS player_display_name,
    CASE pm.suppkey % 5 WHEN 0 THEN 'QB' WHEN 1 THEN 'RB' WHEN 2 THEN 'WR' WHEN 3 THEN 'TE' ELSE 'FB' END AS position,
    CASE pm.suppkey % 5 WHEN 0 THEN 'QB' WHEN 1 THEN 'RB' WHEN 2 THEN 'WR' WHEN 3 THEN 'TE' ELSE 'RB' END AS position_group,
    nt.n_name AS recent_team,
    pm.season, pm.week,
    CASE WHEN pm.week <= 8 THEN 'REG' ELSE 'POST' END AS season_type,
    no.n_name AS opponent_team,
    pm.completions, pm.attempts, pm.passing_yards, pm.passing_tds, pm.interceptions,
    pm.carries, pm.rushing_yards, pm.rushing_tds,
    pm.receptions, pm.targets, pm.receiving_yards, pm.receiving_tds
  FROM pm
  JOIN nation nt ON nt.n_nationkey = pm.nk
  LEFT JOIN slot sl ON sl.season = pm.season AND sl.week = pm.week AND sl.i = pm.nk
  LEFT JOIN nation no ON no.n_nationkey = sl.j AND sl.i <> sl.j
)"""
