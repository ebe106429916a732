"""Files and tables: what is read, and what is written."""
