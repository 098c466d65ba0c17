"""corpusloom: training-data preparation and evaluation on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, joins, aggregates and windows.  Nothing collects data to the
driver; Python code runs only inside Spark tasks where noted.
"""

__all__ = ["session", "constants"]
