"""Jobs and derived tables composed from the operators, and the query
catalogue (``catalog``) that ``__spark_entry__`` exposes."""
