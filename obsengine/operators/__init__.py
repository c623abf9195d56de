"""DataFrame → DataFrame operators: state, SCD2, rollups, quality, change log."""
