"""Session defaults never override what the session was launched with."""

from sideline.session import DEFAULTS, ensure_checkpoint_dir, get_spark


def test_defaults_applied_and_checkpoint_present(spark):
    again = get_spark()
    assert again is spark
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        assert spark.conf.get(key) == DEFAULTS[key]
    assert ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir()


def test_explicit_settings_win(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    get_spark(**{"spark.sql.session.timeZone": "UTC"})
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    spark.conf.set("spark.sql.session.timeZone", before)
