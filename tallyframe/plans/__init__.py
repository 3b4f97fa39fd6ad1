"""The request warehouse: staging, dimensions, fact, reports, checks and the daily run over all of them."""
