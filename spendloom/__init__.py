"""Spendloom: advertising spend and performance analytics as Spark DataFrame operators.

Every table carries a ``client`` key, so one Spark job serves all clients.
"""

from spendloom.params import Params

__all__ = ["Params"]
