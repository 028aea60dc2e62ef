"""Models, reports and checks."""
