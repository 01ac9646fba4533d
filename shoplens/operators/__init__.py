"""DataFrame -> DataFrame operators of the click analyses."""
