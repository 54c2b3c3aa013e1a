"""Column-to-Column building blocks; every one of them stays inside Catalyst."""
