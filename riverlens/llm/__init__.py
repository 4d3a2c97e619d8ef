"""Operators of a training-data pipeline over large text tables.

Each module holds one operator with its own general interface; ``queries``
registers one thin query per operator.  Nothing else in the library imports
this package.
"""
