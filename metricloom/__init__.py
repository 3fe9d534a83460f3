"""metricloom: labelled time-series ingestion and reads on Spark DataFrames."""
