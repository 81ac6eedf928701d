"""Job plans: the end-to-end run, the query registry and the command line."""
