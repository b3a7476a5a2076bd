"""Spatial exposure analytics expressed as Spark DataFrame plans."""

from perilgrid.functions.buckets import width_bucket
from perilgrid.functions.sql import create_feature_view, register
from perilgrid.operators.hexbin import hex_bin
from perilgrid.operators.spatial_join import spatial_join
from perilgrid.schema import FEATURE_TYPES, schema_from_spec
from perilgrid.sources.feature_table import read_feature_table, write_feature_table

__all__ = [
    "FEATURE_TYPES",
    "create_feature_view",
    "hex_bin",
    "read_feature_table",
    "register",
    "schema_from_spec",
    "spatial_join",
    "width_bucket",
    "write_feature_table",
]
