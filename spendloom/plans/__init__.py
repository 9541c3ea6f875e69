"""Whole plans: the model graph, saved queries and the driver-table mapping."""
