"""Table operators: DataFrame in, DataFrame out, all keyed by the target company."""
