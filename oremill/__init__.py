"""oremill: a medallion (bronze, silver, gold) retail pipeline built from DataFrame operators."""
