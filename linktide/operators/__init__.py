"""DataFrame operators: pages, graph, skew handling and ranking."""
