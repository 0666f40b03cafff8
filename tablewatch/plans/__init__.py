"""The three end-to-end flows and the queries registered for the supplied tables."""
