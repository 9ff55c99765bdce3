"""Operators for large training-text corpora.

One module per operator; ``queries`` registers them over the given tables
and ``oracle`` holds the SQL of those that SQL can express.  Nothing else
in the package imports this subpackage.
"""
