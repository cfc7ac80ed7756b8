"""DataFrame-in, DataFrame-out operators of the history warehouse."""
