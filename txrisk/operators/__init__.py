"""Table operators: DataFrame in, DataFrame out. They serve batch and stream alike."""
