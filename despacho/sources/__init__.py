"""Where the base tables come from."""
