"""The jobs: BRONZE cleaning, SILVER, GOLD, checks, metrics and the daily run."""
