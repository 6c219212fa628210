"""Plans: whole runs made of operators."""
