"""Dataset operators: DataFrame to DataFrame."""
