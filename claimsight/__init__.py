"""claimsight: Spark-native claims analytics, data quality and fraud detection.

Layers (all lazy DataFrames until an action):

* ``sources``   - readers for raw tables (CSV/JSON/Parquet) and the mapping of
                  the benchmark tables onto the claim relations.
* ``functions`` - reusable Column expressions (tiers, bands, phases, ...).
* ``operators`` - quality checks, gate, monitoring, fraud rules, upserts.
* ``plans``     - staging / intermediate / mart models, features, reports.
* ``streaming`` - Structured Streaming jobs built on the same operators.
"""

__version__ = "0.1.0"
