"""Column builders: no DataFrames, no actions, no UDFs."""
