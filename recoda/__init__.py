"""recoda: reclassify coded records from an old nomenclature to a new one, on Spark.

Every public operator takes and returns lazy DataFrames (or Columns for scalar
logic).  Sub-packages:

* ``sources``   – scans, sheets, templates, result datasets, fixtures, sinks
* ``functions`` – Column -> Column scalar logic (codes, text, votes, responses)
* ``operators`` – DataFrame -> DataFrame relational steps (dedup, joins, kNN, ...)
* ``plans``     – the composite jobs and the oracle SQL used to check them
* ``streaming`` – the recode step applied to a stream of incoming declarations
"""

from recoda.session import build_session, checkpoint_root, sized_broadcast

__all__ = ["build_session", "checkpoint_root", "sized_broadcast"]
