"""DataFrame-to-DataFrame operators over click tables."""
