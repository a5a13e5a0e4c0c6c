"""Fixed values of the feeds: columns, kinds and names."""
