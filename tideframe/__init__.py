"""tideframe: parameterised DataFrame operators for time-stamped content and event metrics on Spark."""
