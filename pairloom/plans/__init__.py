"""Plans: the registered queries and the views on which they run."""
