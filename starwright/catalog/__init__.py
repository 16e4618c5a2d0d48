"""Every operator as a runnable query over the given tables, and its SQL counterpart."""
