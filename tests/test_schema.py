import pytest
from pyspark.sql import types as T

from perilgrid.schema import FEATURE_TYPES, FID, POINT, POLYGON, schema_from_spec
from perilgrid.session import new_dir
from perilgrid.sources.feature_table import create_feature_table, read_feature_table

ATTRIBUTES = {
    "siteexposure_event": 108,
    "policyexposureevent": 70,
    "portfolioaccountevent": 24,
    "sitelossanalyzevent": 14,
    "hexzoomevent": 2,
    "nzgrid_event": 21,
    "wildfireevent": 25,
    "txmsitehexbinevent": 6,
    "txmsiteexposureevent": 4,
}


def test_attribute_counts():
    assert {n: len(f.schema) for n, f in FEATURE_TYPES.items()} == ATTRIBUTES


def test_long_and_short_type_names_and_geometry_options():
    schema = schema_from_spec("id:java.lang.Long,v:Double,name:String,*geom:Point:srid=4326,area:Polygon:srid=4326")
    assert [f.dataType for f in schema] == [T.LongType(), T.DoubleType(), T.StringType(), POINT, POLYGON]
    assert schema["geom"].metadata == {"geometry": "Point", "srid": 4326, "default_geometry": True}
    assert "default_geometry" not in schema["area"].metadata


@pytest.mark.parametrize("spec", ["a", "a:Decimal", "*a:Long"])
def test_bad_specs(spec):
    with pytest.raises(ValueError):
        schema_from_spec(spec)


def test_default_geometries():
    found = {n: f.default_geometry for n, f in FEATURE_TYPES.items() if f.default_geometry}
    assert found == {"siteexposure_event": "geom", "nzgrid_event": "SHAPE", "wildfireevent": "geometry"}


@pytest.mark.parametrize("name", list(FEATURE_TYPES))
def test_schema_roundtrip(spark, name):
    root = new_dir(spark, "schema")
    create_feature_table(spark, root, name)
    df = read_feature_table(spark, root, name)
    assert df.columns == [FID, *FEATURE_TYPES[name].schema.fieldNames()]
    assert [f.dataType for f in df.schema] == [f.dataType for f in FEATURE_TYPES[name].table_schema]
    assert df.count() == 0
    with pytest.raises(Exception, match="already exists"):
        create_feature_table(spark, root, name)
