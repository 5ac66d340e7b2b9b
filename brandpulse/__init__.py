"""brandpulse: brand-mention sentiment scoring on Spark (DataFrames, Spark ML, Structured Streaming).

Main entry points:

* ``plans.composites.score_mentions`` / ``run_score_job``: classify messages naming
  a brand and score each brand (C1);
* ``functions.text``: the text column functions;
* ``operators``: mentions, scoring, labels, keyed merge, model;
* ``streaming.ingest``: file-stream routing and running repeat counts.
"""

__version__ = "0.1.0"
