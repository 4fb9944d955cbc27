"""Plans: join strategies, the layered pipeline and the query catalogue."""
