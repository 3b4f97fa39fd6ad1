"""Table operators: DataFrame in, DataFrame out.

Those that number rows, keep history or use a result twice store intermediate tables, hence run jobs when called; the others
are lazy.
"""
