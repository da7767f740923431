"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  Each operator module has a
general interface (column names, thresholds and file paths are parameters);
``queries`` registers one thin query per operator over the driver tables.
"""
