"""Operators put together: the batch form of the pipeline, and the BI views."""
