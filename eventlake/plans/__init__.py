"""Jobs that chain the operators over stored layers, and the query catalogue."""
