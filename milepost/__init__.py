"""milepost: Spark-native analytics for milestone-based journeys.

Every operator is a DataFrame -> DataFrame function built on native Spark
expressions (Catalyst plans, whole-stage codegen).  Subpackages:

* ``sources``    readers (explicit schemas), the test-data journey mapping, sinks
* ``functions``  reusable Column expressions (time arithmetic, binning, hashing)
* ``operators``  derivation, data quality, splitting, features, encoders,
                 baselines, ETA / risk models, evaluation, profiling, reporting
* ``plans``      end-to-end job composition and the registered query catalog
* ``streaming``  incremental (Structured Streaming) form of the as-of snapshots
"""

from milepost.config import Config

__all__ = ["Config"]
