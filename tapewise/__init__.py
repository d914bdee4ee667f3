"""tapewise: credit-risk exploration and modelling on Spark DataFrames.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects and is
expressed with built-in Spark SQL functions so that Catalyst can prune,
push down and fuse it.  Sub-packages:

* ``sources``    - reading tapes and lookup maps, the derived ``loan_tape``
* ``functions``  - reusable column expressions (labels, bins, hashes, logs)
* ``operators``  - cleaning, profiling, association, returns, portfolios,
                   splits, curves, models and tuning
* ``plans``      - the registered queries and their DuckDB oracles
"""

from tapewise.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
