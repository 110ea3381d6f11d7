"""dossier: profile and entity data processing on Spark DataFrames.

Sub-packages:
  functions  - Column -> Column rules (text, dates, numbers, hashing)
  operators  - DataFrame -> DataFrame operators (lookup, dedup, metrics, quality, events)
  sources    - readers, extractors and the keyed table store
  streaming  - Structured Streaming versions of the event operators
  plans      - the registered queries over the driver's tables
"""

__version__ = "0.1.0"
