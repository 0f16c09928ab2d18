"""Feature mining over related tables, and operators for training data, as Spark plans."""
