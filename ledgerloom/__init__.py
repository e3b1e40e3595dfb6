"""ledgerloom: DataFrame operators and MLlib pipelines for messy transaction tables."""

__version__ = "0.1.0"
