"""poststream: streams and tables of short text posts on Spark.

Sub-packages:
  functions  Column -> Column expressions (cleaning, lexicon matching, time, keywords)
  operators  DataFrame -> DataFrame operators (lexicon, ingest, dashboard terms, classifier)
  sources    readers and writers (wire JSON, training CSV, seen-ledger, fixture view)
  streaming  Structured Streaming jobs (enrichment, dedup, keyed upsert, trends)
  plans      the registered queries and their SQL twins
"""

__version__ = "0.1.0"
