"""tidemark: analytics over filings, prices, tests and forecasts as Spark DataFrames."""
