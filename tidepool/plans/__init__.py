"""Job compositions (J1-J7) and the registered queries with their oracles."""
