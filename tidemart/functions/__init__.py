"""tidemart."""
