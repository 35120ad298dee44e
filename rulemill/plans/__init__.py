"""Named queries over the given tables, each with a SQL check where SQL can say it."""
