"""Reading artifacts: scan, MIME, HTML grids, the parse stage, mapping files."""
