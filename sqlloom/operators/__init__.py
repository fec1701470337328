"""DataFrame -> DataFrame operators: gates, ranking, sampling, lookups, voting, inference."""
