"""Reading and writing the tables of a layer."""
