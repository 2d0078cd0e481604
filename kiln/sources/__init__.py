from kiln.sources.io import (  # noqa: F401
    TABLES, read_csv, read_json, read_lines, read_sequence_files, read_split,
    read_table, save_model, load_pipeline_model, synthetic_line, typed_frame,
    write_json, write_parquet,
)
