"""Operators of a training-data pipeline over the ``documents`` family of tables.

Nothing else in the library imports this subpackage.  ``queries`` registers one
query per operator (``opN_<name>``) and the pipeline.
"""
