"""Traffic-event analytics on Spark: raw JSON -> checked rows -> star schema -> BI views."""

__version__ = "0.1.0"
