"""Training-data operators: search, joins, tokens, licences, duplicates, toxicity and mixing, on Spark DataFrames."""
