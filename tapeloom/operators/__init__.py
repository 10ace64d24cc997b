"""DataFrame -> DataFrame operators on bars, ratios, statements and macro series."""
