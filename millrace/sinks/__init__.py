"""Writers: full reload, append, upsert, partitioned Parquet, load verification."""
