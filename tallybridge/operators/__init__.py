"""DataFrame-in, DataFrame-out steps of each layer."""
