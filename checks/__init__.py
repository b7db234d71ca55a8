"""Every operator as a query on the given tables, with the SQL that must give the same rows."""
