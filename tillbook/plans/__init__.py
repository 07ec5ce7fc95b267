"""Plans: the daily build wiring and its SQL oracle."""
