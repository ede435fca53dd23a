"""Model graph, registered queries and the end-to-end pipeline runner."""
