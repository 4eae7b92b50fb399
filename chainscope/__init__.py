"""chainscope: ledger analytics (time series, rankings, block overhead and
wash-trading detection) expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
