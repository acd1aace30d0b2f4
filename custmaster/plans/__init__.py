"""Plans: the eight datasets, the daily batch, the query registry and its oracles."""
