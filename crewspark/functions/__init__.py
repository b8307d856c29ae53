"""crewspark.functions."""
