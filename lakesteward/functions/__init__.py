"""Column functions: text, lists, maps and name catalogues."""
