"""Data operators for moving, grouping, ordering and auditing keyed tables on Spark.

Every operator takes and returns a DataFrame (or a Column).  See README.md for a tour.
"""
