"""The analytical tables: staging, star schema and marts as functions of DataFrames."""
