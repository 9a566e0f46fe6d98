"""millrace: loading, merging and checking a star schema with plain Spark DataFrames.

Operators are pure ``DataFrame -> DataFrame`` functions.  Reading and writing
happen only in :mod:`millrace.sources`; every clock is an argument.
"""

__version__ = "0.1.0"
