"""Single steps of the billing pipeline."""
