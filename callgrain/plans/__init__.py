"""Results: subscriber features, mobility indicators, and the jobs that write them."""
