"""Writers: delimited files, Parquet and JDBC."""
