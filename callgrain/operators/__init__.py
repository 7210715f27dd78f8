"""Steps shared by several results; each maps DataFrames to a DataFrame."""
