"""Named queries over the given tables, each with the SQL it is compared to."""
