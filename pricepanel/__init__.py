"""Consumer-price nowcasts from append-only panels of advertised prices, as Spark jobs."""
