"""Tables: loading, declared schemas and keys, delimited files."""
