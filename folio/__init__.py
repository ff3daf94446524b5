"""folio: document analytics on Spark DataFrames."""
