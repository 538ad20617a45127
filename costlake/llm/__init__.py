"""Operators of a large-scale training-data pipeline.

Each module holds one operator with a general interface; ``queries`` has the
thin named queries over the driver tables and ``oracle`` their SQL, where SQL
can express them. Nothing else in the library imports this subpackage.
"""
