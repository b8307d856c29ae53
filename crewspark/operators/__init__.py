"""crewspark.operators."""
