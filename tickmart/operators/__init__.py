"""Library operators: DataFrame in, DataFrame out."""
