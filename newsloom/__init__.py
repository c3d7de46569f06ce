"""Build and analyse financial-news corpora with Spark DataFrames."""
