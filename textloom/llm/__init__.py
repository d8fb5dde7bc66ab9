"""Operators for preparing training data at large scale, each with a query over the driver's tables."""
