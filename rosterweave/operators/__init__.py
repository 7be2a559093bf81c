"""DataFrame -> DataFrame steps. All are lazy."""
