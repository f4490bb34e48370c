"""Writers: bronze landing, dead letters and layer tables."""
