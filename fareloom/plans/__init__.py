"""Plans: the layer pipeline and the answers over its gold layer."""
