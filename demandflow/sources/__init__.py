"""Reading landing files, tables and generated rows."""
