"""crewspark.sources."""
