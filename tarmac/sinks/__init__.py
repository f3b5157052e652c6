"""Writers for curated data, result tables, replay files, models and logs."""
