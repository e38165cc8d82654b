"""Scans (S1-S4, S8) and sinks."""

from tabula.sources.tables import (  # noqa: F401
    TABLES, load_tables, read_csv, read_feature_table, read_score_files, table,
)
from tabula.sources.sinks import (  # noqa: F401
    fill_template, materialize, score_file_name, scratch_folder, write_scores, write_table,
)
