"""Join helpers: when a side may be broadcast.

A side is broadcast only when its size has a checked bound that does not grow
with the player data.  Frames keyed by (season, week, team) or (season, team)
hold at most two rows a game for every row of the schedule they are made of,
so the stored size of the schedule bounds them, however many player rows
exist.  Spark's static estimate cannot see that (an aggregate is estimated as
large as its input, a join as the product), and AQE would only switch to a
broadcast after both shuffle map stages ran, i.e. after the big player side
had already been shuffled on a key with only a few thousand distinct values.
So these joins carry an explicit hint, given after the stored size was read
from the plan (file sizes; no job runs).

Beyond ``sideline.broadcastBytes`` stored bytes (8 MB: some hundred thousand
games, whose decoded rows are tens of MB) there is no hint: the planner and AQE
choose from measured sizes, by a sort-merge join or a broadcast of their own.
Where the stored size is unknown (rows of an RDD), rows are counted, and no
further than ``BROADCAST_ROWS``.
``spark.conf.set("sideline.broadcastBounded", "false")`` switches all hints off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONF_KEY = "sideline.broadcastBounded"
BYTES_KEY = "sideline.broadcastBytes"
BROADCAST_BYTES = 8 << 20
BROADCAST_ROWS = 200_000
#: What a plan says of a source whose size it does not know.
UNKNOWN_BYTES = (1 << 63) - 1


def source_bytes(df: DataFrame) -> int:
    """Stored bytes of the tables a frame is made of, as its plan knows them; UNKNOWN_BYTES or more if it does not."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def _hints_on(df: DataFrame) -> bool:
    return df.sparkSession.conf.get(CONF_KEY, "true").lower() != "false"


def bounded(df: DataFrame, made_of: DataFrame | None = None) -> DataFrame:
    """Broadcast hint for a frame that is small because what bounds it is: ``made_of`` (the schedule), else all it reads."""
    if not _hints_on(df):
        return df
    proof = df if made_of is None else made_of
    limit = int(df.sparkSession.conf.get(BYTES_KEY, str(BROADCAST_BYTES)))
    size = source_bytes(proof)
    small = size <= limit if size < UNKNOWN_BYTES else proof.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(df) if small else df


def short(df: DataFrame) -> DataFrame:
    """Broadcast hint for a frame whose rows something on the driver bounds: a list it made, or one row a column of a schema."""
    return F.broadcast(df) if _hints_on(df) else df
