"""tideframe functions."""
