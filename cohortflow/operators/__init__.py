"""DataFrame operators: lazy, free of hidden actions, no Python UDFs."""
