"""DataFrame operators: pure functions, DataFrame in -> DataFrame out."""
