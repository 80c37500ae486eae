"""Column expressions: type tags, cell normalisers, row normalisers."""
