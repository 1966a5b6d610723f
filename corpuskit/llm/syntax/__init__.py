"""Recognition of source files by generalised LL parsing, several dialects at once."""
