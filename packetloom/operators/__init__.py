"""DataFrame-to-DataFrame operators; each can be used with `DataFrame.transform`."""
