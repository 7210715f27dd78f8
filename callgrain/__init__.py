"""Subscriber features and mobility indicators from call detail records, on Spark."""
