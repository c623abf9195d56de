"""Sources: driver tables, landing (response log + payload files), payload
parsing, and the bindings that derive observation data from the tables."""
