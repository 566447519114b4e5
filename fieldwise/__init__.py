"""fieldwise: multi-source entity resolution and report typing on Spark.

Sub-packages:
  sources    scans, seeds, nested flattening, report landing (S*)
  functions  Column-returning scalar functions (X*)
  operators  joins, resolution, rules, change detection, quality, access (J*, R*, C*, Q*, A*)
  streaming  Structured Streaming operators over the event feed (E*)
  plans      model registry and the registered queries over the driver tables (W*)
"""

__version__ = "0.1.0"
