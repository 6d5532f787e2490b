"""DataFrame-to-DataFrame operators; the same code serves tables and micro-batches."""
