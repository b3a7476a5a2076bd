"""Declared feature types and the spec-string parser that turns them into Spark schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FID = "__fid__"

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
BOX = T.StructType([T.StructField(n, T.DoubleType()) for n in ("xmin", "ymin", "xmax", "ymax")])
# rings of all parts; `parts` has the number of rings of each, null for a polygon of one part
POLYGON = T.StructType(
    [
        T.StructField("rings", T.ArrayType(T.ArrayType(POINT))),
        T.StructField("bbox", BOX),
        T.StructField("parts", T.ArrayType(T.IntegerType())),
    ]
)

_TYPES = {
    "Long": T.LongType(),
    "Integer": T.IntegerType(),
    "Double": T.DoubleType(),
    "String": T.StringType(),
    "Boolean": T.BooleanType(),
    "Point": POINT,
    "Polygon": POLYGON,
}
_GEOMETRIES = ("Point", "Polygon")


def schema_from_spec(spec: str | list[str]) -> T.StructType:
    """Parse ``name:type[:srid=n]`` attributes; a leading ``*`` marks the default geometry.

    Type names may be short (``Long``) or carry a package prefix (``java.lang.Long``).
    """
    items = spec.split(",") if isinstance(spec, str) else spec
    fields = []
    for item in (i.strip() for i in items):
        if not item:
            continue
        name, *rest = item.split(":")
        if not rest:
            raise ValueError(f"attribute {item!r} has no type")
        default_geometry = name.startswith("*")
        type_name = rest[0].rsplit(".", 1)[-1]
        if type_name not in _TYPES:
            raise ValueError(f"unknown type {rest[0]!r} in {item!r}")
        metadata: dict = {}
        if type_name in _GEOMETRIES:
            metadata["geometry"] = type_name
            for option in rest[1:]:
                key, _, value = option.partition("=")
                metadata[key] = int(value)
        elif default_geometry:
            raise ValueError(f"{item!r} is marked default geometry but is not one")
        if default_geometry:
            metadata["default_geometry"] = True
        fields.append(T.StructField(name.lstrip("*"), _TYPES[type_name], True, metadata))
    return T.StructType(fields)


@dataclass(frozen=True)
class FeatureType:
    """A named schema together with the physical table that stores it."""

    name: str
    table: str
    spec: str

    @property
    def schema(self) -> T.StructType:
        return schema_from_spec(self.spec)

    @property
    def table_schema(self) -> T.StructType:
        """Stored layout: the feature id first, then the attributes."""
        return T.StructType([T.StructField(FID, T.StringType(), False), *self.schema.fields])

    @property
    def default_geometry(self) -> str | None:
        return next((f.name for f in self.schema if f.metadata.get("default_geometry")), None)

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.table_schema)


def geometry_fields(schema: T.StructType) -> dict[str, str]:
    """Geometry columns of a schema, recognised by their struct layout."""
    found = {}
    for field in schema:
        names = field.dataType.fieldNames() if isinstance(field.dataType, T.StructType) else []
        if names == ["x", "y"]:
            found[field.name] = "Point"
        elif names[:2] == ["rings", "bbox"]:
            found[field.name] = "Polygon"
    return found


# Attribute names, types and order of the nine feature types.
_SITE_EXPOSURE = """
portfolio_id:Long, peril_id:Long, account_id:String, site_id:String, arcgis_id:Long,
nz_grid_id:String, shape:String, sitenum:String, sitename:String, site_lat:Double,
account_num:String, site_long:Double, country_id:Long, currency:String,
g_mc_level1_id:String, g_mc_level2_id:String, g_mc_level3_id:String, g_mc_level4_id:String,
g_mc_level5_id:String, g_mc_level6_id:String, g_level:Long, g_level_source_id:Long,
full_address:String, street_addr:String, municipality:String, postalcode:String,
cresta:String, blg_num:Long, blg_name:String, lob1:String, lob2:String,
occ_short_desc:String, const_short_desc:String, m_air_occind:String, m_air_occ:String,
m_air_constind:String, m_air_const:String, m_rms_occind:String, m_rms_occ:String,
m_rms_constind:String, m_rms_const:String, num_stories:Long, year_built:Long,
expire_date:String, incept_date:String, cov1val:Double, cov2val:Double, cov3val:Double,
cov4val:Double, cov5val:Double, cov6val:Double, risk_count:Long, shift_count:Long,
payroll:Double, empl_count:Double, calc_num_empl:Double, max_empl:Double, shift1:Double,
shift2:Double, shift3:Double, shift4:Double, deduct_type:String, limit_type:String,
premium:Double, site_limit:Double, site_bl_limit:Double, site_deduct:Double,
site_bl_deduct:Double, cmb_deduct:Double, cmb_limit:Double, agg_limit:Double,
cov1limit:Double, cov1deduct:Double, cov2limit:Double, cov2deduct:Double,
cov3limit:Double, cov3deduct:Double, cov4limit:Double, cov4deduct:Double,
cov4days:Double, cov5limit:Double, cov5deduct:Double, cov6limit:Double,
cov6deduct:Double, rms_distance_coast:Double, s_udf_met1:Double, s_udf_met2:Double,
s_udf_met3:Double, s_udf_met4:Double, s_udf_met5:Double, s_udf_met6:Double,
s_udf_met7:Double, s_udf_met8:Double, s_udf_met9:Double, s_udf_met10:Double,
s_udf_attr1:String, s_udf_attr2:String, s_udf_attr3:String, s_udf_attr4:String,
s_udf_attr5:String, s_udf_attr6:String, s_udf_attr7:String, s_udf_attr8:String,
s_udf_attr9:String, s_udf_attr10:String, site_comments:String,
*geom:Point:srid=4326, shapegeom:Point:srid=4326
"""
_POLICY_EXPOSURE = """
portfolio_id:Long, peril_id:Long, policy_id:Long, account_id:Long, account_num:Long,
policy_status:String, pol_lob:String, policy_name:String, policy_num:Long,
incept_date:String, expire_date:String, deduct_type:String, limit_type:String,
prorata:String, undercover:String, premium:String, policy_deduct:String,
policy_bl_deduct:String, min_deduct:String, max_deduct:String, policy_limit:String,
policy_bl_grosslimit:Double, cov1_limit:Double, cov1_deduct:Double, cov2_limit:Double,
cov2_deduct:Double, cov3_limit:Double, cov3_deduct:Double, cov4_limit:Double,
cov4_deduct:Double, cov5_limit:Double, cov5_deduct:Double, cov6_limit:Double,
cov6_deduct:Double, agg_deduct:Double, cmb_limit:Double, cmbinded_deduct:Double,
sub_limit:Double, sub_deduct:Double, p_udf_met1:Double, p_udf_met2:Double,
p_udf_met3:Double, p_udf_met4:Double, p_udf_met5:Double, p_udf_met6:Double,
p_udf_met7:Double, p_udf_met8:Double, p_udf_met9:Double, p_udf_met10:Double,
p_udf_met11:Double, p_udf_met12:Double, p_udf_met13:Double, p_udf_met14:Double,
p_udf_met15:Double, p_udf_attr1:Double, p_udf_attr2:Double, p_udf_attr3:Double,
p_udf_attr4:Double, p_udf_attr5:Double, p_udf_attr6:Double, p_udf_attr7:Double,
p_udf_attr8:Double, p_udf_attr9:Double, p_udf_attr10:Double, p_udf_attr11:Double,
p_udf_attr12:Double, p_udf_attr13:Double, p_udf_attr14:Double, p_udf_attr15:Double,
policy_comments:String
"""
_PORTFOLIO_ACCOUNT = """
portfolio_id:Long, account_id:Long, account_name:String, account_num:Long, company:String,
division:String, producer:String, branch:String, peril_id:Long, a_udf_met1:Double,
a_udf_met2:Double, a_udf_met3:Double, a_udf_met4:Double, a_udf_met5:Double,
a_udf_attr1:Double, a_udf_attr2:Double, a_udf_attr3:Double, a_udf_attr4:Double,
a_udf_attr5:Double, a_udf_attr6:Double, a_udf_attr7:Double, a_udf_attr8:Double,
a_udf_attr9:Double, a_udf_attr10:Double
"""
_SITE_LOSS = """
portfolio_id:Long, analysis_id:Long, site_id:String, account_id:String, vendor_id:Long,
model_id:Long, peril_id:Long, gross_loss:Double, damage_loss:Double, net_loss:Double,
occ_id:Long, occ_ind:String, const_id:Long, const_ind:String
"""
_HEX_ZOOM = "zoom_id:Long, zoom_value:Long"
_GRID = """
OBJECTID:Long, g_country_id:Long, g_mc_level1_id:Long, g_mc_level2_id:Long,
g_mc_level3_id:Long, g_mc_level4_id:Long, g_mc_level5_id:Long, g_mc_level6_id:Long,
g_mc_level1_wgt:Double, g_mc_level2_wgt:Double, g_mc_level3_wgt:Double,
g_mc_level4_wgt:Double, g_mc_level5_wgt:Double, g_mc_level6_wgt:Double,
geo_unit_id:Long, nz_grid_id:Long, maxx:Double, maxy:Double, minx:Double, miny:Double,
*SHAPE:Polygon:srid=4326
"""
_WILDFIRE = """
OBJECTID:Long, ArcGIS_DBO_CatEvents_Fire_2000:Double, PERIMETER:Double, FIRE_NAME:String,
COMPLEX:String, ACRES:Double, MILES:Double, YEAR_:String, AGENCY:String, UNITID:String,
FIRENUM:String, TIME_:String, METHOD:String, SOURCE:String, TRAVEL:String,
MAPSCALE:String, PROJECTION:String, UNITS:String, DATUM:String, COMMENTS:String,
Shape_STArea__:Double, Shape_STLength__:Double, SHAPE.STArea:Double,
SHAPE.STLength:Double, *geometry:Polygon:srid=4326
"""
_SITE_HEX_BIN = """
portfolio_id:Long, account_id:String, site_id:String, lod:Long, arow:Long, acol:Long
"""
_SITE_GRID = "portfolio_id:Long, site_id:String, g_country_id:Long, geo_unit_id:Long"

FEATURE_TYPES: dict[str, FeatureType] = {
    f.name: f
    for f in (
        FeatureType("siteexposure_event", "site_exposure_1M", _SITE_EXPOSURE),
        FeatureType("policyexposureevent", "policy_exposure_1M", _POLICY_EXPOSURE),
        FeatureType("portfolioaccountevent", "portfolio_account_1M", _PORTFOLIO_ACCOUNT),
        FeatureType("sitelossanalyzevent", "site_loss_analysis_1M", _SITE_LOSS),
        FeatureType("hexzoomevent", "hex_zoom", _HEX_ZOOM),
        FeatureType("nzgrid_event", "nzgrid", _GRID),
        FeatureType("wildfireevent", "CatEvents_Fire_2000_US_Wildfire_Footprint", _WILDFIRE),
        FeatureType("txmsitehexbinevent", "txm_site_hex_bin", _SITE_HEX_BIN),
        FeatureType("txmsiteexposureevent", "txm_site_exposure_1M", _SITE_GRID),
    )
}
