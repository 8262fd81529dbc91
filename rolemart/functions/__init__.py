"""Column helpers that fix one meaning where SQL engines differ."""
