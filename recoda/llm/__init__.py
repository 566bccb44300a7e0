"""Training-data operators: whole-corpus filters, dedups, tokenisation and output.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds
its queries when it is there.  Every operator takes the columns it needs by name
(other columns of the input never clash with it) and returns a DataFrame.
"""
