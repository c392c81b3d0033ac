"""Reading and writing: raw lines, layers, scratch tables and the sample mapping."""
