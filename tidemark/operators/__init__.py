"""DataFrame operators. Column names are parameters, so they serve headlines, prices and other tables."""
