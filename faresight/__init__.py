"""faresight: taxi-trip analytics expressed as Spark DataFrame / SQL / Structured Streaming plans.

Every operator is a function ``f(DataFrame, ..., params) -> DataFrame``; only
``faresight.sources`` reads paths and only ``faresight.sinks`` writes them.
"""

__version__ = "0.1.0"
