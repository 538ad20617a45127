"""costlake: cloud cost and usage analytics as Spark DataFrame functions.

Every operator takes DataFrames and returns a DataFrame; only
``costlake.sources.tables`` and ``costlake.plans.pipeline`` write.
"""

__version__ = "0.1.0"
