"""leafmill: files -> text -> structured records -> queryable table, on Spark."""
