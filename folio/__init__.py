"""folio: documents to knowledge items, on Spark DataFrames."""
