"""DataFrame -> DataFrame operators on the raw tables."""
