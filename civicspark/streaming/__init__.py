"""No operator here needs a stream: all sources are batches that are replaced or reloaded as a whole."""
