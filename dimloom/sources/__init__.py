"""Reading sources and reading and writing the warehouse tables."""
