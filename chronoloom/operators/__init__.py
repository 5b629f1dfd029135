"""DataFrame-to-DataFrame operators on point tables and wide frames."""
