"""DataFrame-in, DataFrame-out operators over catalogs, tags and grants."""
