"""Reading and writing: cell tables, text files and JSON event streams."""
