"""The three end-to-end preparations: carbon pricing, indicators, scenarios."""
