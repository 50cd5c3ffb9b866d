"""Analytics over a fleet of managed computers, as plain functions on Spark DataFrames.

``functions``  column expressions (text cuts, versions, numbers, times, code lists)
``sources``    readers and sinks (tables, delimited files, XML feeds, landed HTML, event messages)
``operators``  DataFrame -> DataFrame building blocks (latest snapshot, roll-ups, upsert, reconcile)
``plans``      whole reports composed from the above
``streaming``  Structured Streaming forms of the stateful jobs
``bindings``   the reports and operators bound to the driver's test tables, with their SQL checks
"""

from fleetquarry.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
