"""Named queries: the operators bound to tables, and the SQL that checks them."""
