"""DataFrame-to-DataFrame operators, usable on streams and batches."""
