"""Title performance endpoint: measured values and forecasts merged into one table per title and season."""
