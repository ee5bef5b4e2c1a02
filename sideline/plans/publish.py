"""Publish the mart layer as tables for dashboards and other readers.

The source defined views that a dashboard read.  Here every mart can be
written as a parquet table.  The two wide bases (enriched team games, player
games) are checkpointed into the shared checkpoint folder first, so the
marts do not each recompute them; marts that grow with the player data are
partitioned by season, the calendar-bounded ones are written as they are.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from sideline.operators.maintain import row_counts
from sideline.plans.marts import Marts
from sideline.sources.io import write_table

# Views whose size follows the player data; the others are bounded by the
# calendar (seasons x weeks x teams) or by the number of players.
PLAYER_SIZED = {"v_player_games", "v_player_games_keys", "v_rb_rolling3", "v_wr_rolling3",
                "v_te_rolling3", "v_qb_rolling3"}


def publish_marts(m: Marts, out_dir: str, names: Iterable[str] | None = None,
                  checkpoint_bases: bool = True, database: str | None = None) -> DataFrame:
    """Write the named views (default: all) under ``out_dir``; returns (table_name, rows).

    With ``database`` (for example ``"mart"``) each written table is also
    registered in the session catalog as ``<database>.<view name>``, so SQL
    written against the source's view schema (``mart.v_team_games``, ...)
    runs unchanged.
    """
    if checkpoint_bases:
        m.persist_bases(checkpoint=True)
    views = m.views()
    chosen = list(views) if names is None else list(names)
    spark = m.schedules.sparkSession
    written = {}
    for name in chosen:
        path = f"{out_dir.rstrip('/')}/{name}"
        df = views[name]
        if name in PLAYER_SIZED:
            write_table(df.hint("rebalance", "season"), path, "overwrite", ("season",))
        else:
            write_table(df, path, "overwrite")
        written[name] = spark.read.parquet(path)
        if database is not None:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
            if name in PLAYER_SIZED:
                spark.sql(f"MSCK REPAIR TABLE {database}.{name}")
    return row_counts(written)
