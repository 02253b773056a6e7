"""The jobs: pure functions over DataFrames that return DataFrames and write no state."""
