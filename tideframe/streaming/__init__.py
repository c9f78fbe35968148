"""tideframe streaming."""
