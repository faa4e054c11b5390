"""Writers for the clean layer, the marts and the catalog."""
