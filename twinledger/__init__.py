"""Source/target data validation as Spark jobs."""

from twinledger.model import ColumnPair, DatasetError, RunConfig, ValueClass

__all__ = ["ColumnPair", "DatasetError", "RunConfig", "ValueClass"]
