"""Plant-quality analytics on Spark: bronze/silver/gold tables, checks, features, models, reports."""
