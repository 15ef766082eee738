"""Every operator as a query over the given tables, each with an SQL text to check it against."""
