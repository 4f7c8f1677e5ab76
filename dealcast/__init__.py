"""dealcast: promotional-deal panel analytics on Spark.

Posts (free-text deal rows) -> parsed labels -> brand x day panel ->
calendar / holiday / lag features -> splits -> forecasts and classifiers ->
exact metrics -> per-brand advice. Everything is expressed with DataFrame
operations so Catalyst plans it; see README.md for the operator map.
"""

__version__ = "0.1.0"
