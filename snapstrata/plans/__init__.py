"""Layer plans composed from the operators: landing, refining, star schema, marts."""
