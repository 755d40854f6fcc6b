"""Operators of a training-data pipeline (URL rules, dedup, decontamination, ...).

One module per operator; :mod:`guestfold.llm.queries` registers one driver
query for each.  Nothing outside this package imports it.
"""
