"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

Rules all operators share: a null text counts as empty, repeated rows are kept, an empty table gives an empty table with
the same columns, and where an output column has the name of an input column (letter case aside) the output replaces it.
"""
