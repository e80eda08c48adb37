"""The stateless jobs as streaming queries."""
