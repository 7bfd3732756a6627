"""Reading and writing: named tables, shared scratch space, logs, listings, sinks."""
