"""Complete analyses: published marts, report queries, margin report, medallion flow."""
