"""DataFrame operators: ordering, profiling, evaluation, drift, learning, governance."""
