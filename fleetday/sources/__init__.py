"""CSV families, stored tables and the shared scratch folder."""
