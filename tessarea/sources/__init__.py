"""Readers and sinks: text files, reports with a preamble, workbooks, shapefiles, rasters, paged services, manifests and small reports."""

from tessarea.sources.features import FeatureSource, follow_layer, read_layer
from tessarea.sources.files import (
    hive_scan, input_manifest, is_fresh, markdown_table, read_feature_lines, read_features, read_report, read_strings, require_coverage, sniffed_table, write_report,
)
from tessarea.sources.paged import PagedSource, read_paged, read_portal
from tessarea.sources.raster import RasterSource, read_raster, zonal
from tessarea.sources.shapefile import ShapefileSource, read_shapefile, with_rings
from tessarea.sources.workbook import WorkbookSource, read_workbook, workbook_table

__all__ = [
    "FeatureSource", "PagedSource", "RasterSource", "ShapefileSource", "WorkbookSource", "follow_layer", "hive_scan", "input_manifest", "is_fresh", "markdown_table", "read_feature_lines", "read_features",
    "read_layer", "read_paged", "read_portal", "read_raster", "read_report", "read_shapefile", "read_strings", "read_workbook", "require_coverage", "sniffed_table", "with_rings", "workbook_table", "write_report", "zonal",
]
