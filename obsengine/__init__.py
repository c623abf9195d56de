"""obsengine: a Spark-native engine for observation data.

Raw responses land as immutable files and an append-only response log;
payloads are parsed with distributed column expressions (bad records are
routed to quarantine with a reason); keyed current state is maintained by
newest-wins upserts; facts, type-2 dimensions and hourly rollups are built
on top and served by small rate / weighted-average / trend / top-k queries.

Every operator is a function from DataFrames (or Columns) to DataFrames (or
Columns).  Nothing here creates a session, sets a master or collects rows.
"""

__version__ = "0.1.0"
