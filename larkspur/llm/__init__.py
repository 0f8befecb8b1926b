"""Training-data operators.

Nothing outside this package imports it.  ``registry`` holds the queries and the SQL
that ``__spark_entry__`` adds when the package is there.
"""
