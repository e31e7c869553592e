"""Training-data operators (numbered 1 to 10) and their registered queries.

Nothing else in the library imports this subpackage.
"""
