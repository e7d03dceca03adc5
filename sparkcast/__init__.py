"""Half-hourly time-series preparation and probabilistic forecasting as composable DataFrame operators."""
