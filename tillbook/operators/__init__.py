"""Domain jobs: each is a function DataFrame(s) -> DataFrame."""
