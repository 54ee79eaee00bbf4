"""Batch plans: a source schema's tables in, the target schema's tables out.

Plans read and return dictionaries of DataFrames and write nothing themselves.
Target tables that exist already are passed in and come back with the new rows.
"""
