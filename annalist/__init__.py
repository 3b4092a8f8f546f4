"""Analytics over bitemporal, evidence-backed records, as Spark DataFrames."""
