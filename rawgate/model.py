"""Schemas of control tables and outputs (DDL strings)."""

from __future__ import annotations

EXPECTED_FILES = (
    "file_prefix_nm string, src_sys_nm string, trgt_tbl_nm string, file_type string, "
    "part_file_flag string, hexacodes_flag string, field_delimiter string, "
    "col_header_flag string, intraday_flag string, typecasting_flag string"
)
CHECKLIST = (
    "file_prefix_nm string, file_chck_typ string, arguments string, priority string, "
    "threshold_pre string, eff_seq int, status_flag string, lastupddttm string"
)
MAPPING = (
    "group_name string, key1 string, key2 string, val1 string, val2 string, "
    "eff_seq int, status_flag string, lastupddttm string"
)
FILE_SCHEMA = (
    "file_prefix_nm string, column_name string, col_seq int, col_length int, "
    "data_type string, obfuscate boolean"
)
MANIFEST = "file_nm string, src_sys_nm string, run_id string, snap_dt string, file_prefix_nm string"
FILE_METADATA = "snap_dt string, file_nm string, meta_data_details string"
ROW_COUNT_HISTORY = "file_prefix_nm string, snap_dt string, run_id string, row_count bigint"

# from `config_snap_dt` on a column is hidden, or (`active` false) no longer; `reset_snap_dt` says from where old snapshots were written anew
OBFUSCATION = "file_prefix_nm string, column_name string, config_snap_dt string, reset_snap_dt string, active boolean"

# one JSON object per group; the prefix is the key of the map
PREFIX_CONFIG = (
    "file_prefix_nm map<string, struct<total_column int, escape string, quote string, "
    "type string, drop_field_index array<int>, hex_list array<string>, quote_flag string, "
    "row_tag string>>"
)

STATUS = (
    "snap_dt string, run_id string, file_nm string, src_sys_nm string, file_prefix_nm string, "
    "glue_table_nm string, action_type string, action_typ_details string, status string, "
    "time string, run_dt string"
)
STATUS_COLUMNS = [part.split()[0] for part in STATUS.split(", ")]

# the shape every reader hands to the later steps: one row per record
RECORD = (
    "file_nm string, block bigint, line_id bigint, ident string, n_fields int, "
    "malformed boolean, cells array<string>, value string"
)
POSITION = ["file_nm", "block", "line_id"]
