"""The transfer and grant jobs as streaming queries."""
