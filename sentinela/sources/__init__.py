"""Sources and sinks: HTML tables, zip archives, delimited files, layers."""

from sentinela.sources.archives import read_binary_files, unzip_members, zip_members
from sentinela.sources.delimited import fields_to_columns, read_delimited
from sentinela.sources.files import expected_vs_found, file_name, parse_file_name, reporting_end, yearly_windows
from sentinela.sources.html import decode_page, html_table, read_pages, table_rows
from sentinela.sources.layers import BRONZE, GOLD, LAND, SILVER, commit_layer, infer_types, layer_path, live_folders, publish, read_layer, read_layer_inferred, read_staged, stage_layer, write_layer

__all__ = [
    "BRONZE",
    "GOLD",
    "commit_layer",
    "infer_types",
    "live_folders",
    "read_layer_inferred",
    "read_staged",
    "stage_layer",
    "decode_page",
    "LAND",
    "SILVER",
    "expected_vs_found",
    "fields_to_columns",
    "file_name",
    "html_table",
    "layer_path",
    "parse_file_name",
    "publish",
    "read_binary_files",
    "read_delimited",
    "read_pages",
    "read_layer",
    "reporting_end",
    "table_rows",
    "unzip_members",
    "write_layer",
    "yearly_windows",
    "zip_members",
]
