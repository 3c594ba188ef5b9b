"""Plans: specs of dimensions and facts, extract shapes, loads and load control."""
