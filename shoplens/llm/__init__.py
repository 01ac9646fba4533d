"""Operators of a training-data pipeline over the table ``documents``.

One module per operator; ``queries`` registers them. Nothing else in the library
imports this subpackage. Input columns are selected by name, so further columns,
also ones named like an output, never reach an operator.
"""
