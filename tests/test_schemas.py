"""The load step produces exactly the fixed schemas."""

from conftest import SF001
from sideline import schemas
from sideline.plans import warehouse as WH
from sideline.sources import fixtures as FX


def _shape(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_fixture_schemas_match_constants(spark):
    assert _shape(FX.hist_schedules(spark, SF001).schema) == _shape(schemas.HIST_SCHEDULES)
    assert _shape(FX.hist_weekly(spark, SF001).schema) == _shape(schemas.HIST_WEEKLY)


def test_loaded_facts_round_trip(spark):
    hs, hw = WH.facts(spark, SF001)
    assert _shape(hs.schema) == _shape(schemas.HIST_SCHEDULES)
    assert _shape(hw.schema) == _shape(schemas.HIST_WEEKLY)
    assert hs.count() == FX.hist_schedules(spark, SF001).count()
    assert sorted(map(tuple, hw.collect())) == sorted(map(tuple, FX.hist_weekly(spark, SF001).collect()))
    assert WH.is_loaded(spark, SF001)
