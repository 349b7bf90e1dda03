"""Star schema, summary views, OLAP reports and the end-to-end warehouse."""
