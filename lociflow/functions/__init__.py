"""Column expressions: Column in, Column out, all of it inside Catalyst."""
