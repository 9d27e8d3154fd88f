"""tabkit: tabular cleaning, aggregation, feature engineering and learning on Spark DataFrames."""

__version__ = "0.1.0"
