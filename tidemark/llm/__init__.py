"""Operators of a training-data pipeline over large text and vector tables.

One module per operator; ``queries`` registers them over the test tables.
Nothing outside this folder imports it (``__spark_entry__`` adds the queries
when the folder is there).
"""
