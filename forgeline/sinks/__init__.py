"""Writers of the lake (DataFrameWriter only)."""
