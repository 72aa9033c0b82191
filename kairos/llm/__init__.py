"""Operators for training-data pipelines (documents, benchmark, labels, conversations).

Each module holds one operator with a general ``DataFrame -> DataFrame``
interface; ``queries.py`` registers one query per operator and ``oracle.py``
the DuckDB SQL of those that SQL can express.  Nothing else in the library
imports this subpackage.
"""
