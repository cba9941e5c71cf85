"""DataFrame -> DataFrame operators. Column names are arguments with defaults."""
