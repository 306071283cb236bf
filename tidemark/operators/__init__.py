"""Analytics operators; each one maps DataFrames (and parameters) to a DataFrame."""
