"""The reports, views, models and jobs of the case line list."""
