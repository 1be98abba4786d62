"""Feature sets over the driver tables and the registry of named queries."""
