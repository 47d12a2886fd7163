"""Journey datasets composed from the operators, and the registered queries."""
