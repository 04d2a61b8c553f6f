"""The registered queries: raw retail rows derived from the given tables, the operators run on them, and the SQL
each one is compared with."""
