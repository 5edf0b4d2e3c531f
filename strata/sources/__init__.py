"""Bronze, silver, gold and metadata tables at rest."""
