"""Bronze/silver/gold jobs built from the operators."""
