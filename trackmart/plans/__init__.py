"""Reports and the daily batch run."""
