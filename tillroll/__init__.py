"""tillroll: receipt analytics on Spark DataFrames.

Subpackages:

* ``sources``   -- document schemas and loaders, the receipt tables, sinks
* ``functions`` -- column expressions (dates, lenient casts, cleaning rules)
* ``operators`` -- rankings, cohorts, audits, status totals, upserts
* ``plans``     -- the named queries, their reference SQL, the batch load
* ``streaming`` -- incremental document loading with Structured Streaming
"""

__version__ = "0.1.0"
