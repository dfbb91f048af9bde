"""tabflow: Spark-native operators for the data work around a tabular model.

Every operator is a function ``DataFrame -> DataFrame`` (or a small flow of
them) built from the DataFrame/SQL API so that Catalyst and AQE choose the
physical plan.  Sub-packages:

* ``sources``   – table names, reads, appends, staged (versioned) writes,
                  table properties.
* ``functions`` – column expressions (key hashing, id parsing/formatting,
                  hash-derived values, date helpers).
* ``operators`` – split, keyed tables, generation, quality, features,
                  model, evaluation, monitoring.
* ``streaming`` – Structured Streaming forms of the incremental operators.
* ``plans``     – multi-step flows and the catalogue of registered queries.
"""

from tabflow.config import CatFeature, ModelParams, NumFeature, TableSpec

__all__ = ["CatFeature", "ModelParams", "NumFeature", "TableSpec"]
