"""changeloom: change-data analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame.  The session time
zone is expected to be UTC (see :mod:`changeloom.session`).
"""
