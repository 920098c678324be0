"""Document frequencies over a stream of arriving documents."""
