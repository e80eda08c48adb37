"""The jobs and operators, each a function from DataFrame to DataFrame."""
