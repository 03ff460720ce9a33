"""Writers for report tables and report bundles."""
