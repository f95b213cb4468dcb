"""Ready-made jobs: the pharma mart, and the queries registered for checking."""
