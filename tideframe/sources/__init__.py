"""tideframe sources."""
