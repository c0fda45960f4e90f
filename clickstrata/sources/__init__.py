from clickstrata.sources.files import (
    build_mart,
    describe,
    export_parquet,
    in_months,
    layer_exists,
    layer_manifest,
    layer_path,
    month_number,
    read_layer,
    read_nested,
    read_raw_csv,
    read_table,
    register_views,
    replace_months,
    write_layer,
    write_report,
)
from clickstrata.sources.scratch import clear_scratch, scratch_path, stage

__all__ = [
    "build_mart",
    "clear_scratch",
    "describe",
    "export_parquet",
    "in_months",
    "layer_exists",
    "layer_manifest",
    "layer_path",
    "month_number",
    "read_layer",
    "read_nested",
    "read_raw_csv",
    "read_table",
    "register_views",
    "replace_months",
    "scratch_path",
    "stage",
    "write_layer",
    "write_report",
]
