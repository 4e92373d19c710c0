"""Table products, the refresh graph and the dashboard views."""
