"""fleetlake: maintenance, purchasing and fleet datasets as Spark jobs.

Layout
------
functions/  Column -> Column helpers (keys, dates, status labels)
operators/  DataFrame operators (dedup, lookups, batching and delivery, windowed backfill)
sources/    table loading and the adapter views over the star-schema test tables
plans/      the jobs, one function per output dataset
streaming/  incremental re-runs of a job over newly arrived files
"""

from fleetlake.params import Params

__all__ = ["Params"]
