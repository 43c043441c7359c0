"""tidemart: a retail warehouse pipeline on Spark DataFrames.

Change extraction, keep-latest, guarded and unguarded MERGE, day-partition
replacement, product dimensions, an as-of join and sales measures, all as
functions from DataFrames to DataFrames (see README.md).
"""

__version__ = "0.1.0"
