"""Named queries, procedures and readings of plans."""
