"""Column-returning helpers. Everything here stays a Catalyst expression; there are no Python UDFs."""
