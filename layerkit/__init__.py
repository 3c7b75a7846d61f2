"""layerkit: layered pipeline and analytics toolkit written as PySpark DataFrame code.

Subpackages:
  sources    staged files (CSV/JSON), listings, external views, snapshots
  operators  upsert, change capture, validity history, flatten, joins, policies, layout, reports
  functions  Column-expression helpers: geo, calendar, text
  streaming  file ingest and incrementally maintained tables (Structured Streaming)
  plans      the named queries over the shared test tables and their SQL oracles
"""

__version__ = "0.1.0"
