"""tideframe operators."""
