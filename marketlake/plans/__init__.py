"""Whole plans: the batch pipeline, driver-table stand-ins and the query catalog."""
