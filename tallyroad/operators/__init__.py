"""DataFrame operators: parsing, metrics, keyed state, upserts, offsets, cells."""
